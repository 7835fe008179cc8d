"""Move business data between systems on Spark and prove that nothing was lost."""

from tallybridge.functions.rules import apply_rules, register_rule
from tallybridge.operators.changes import apply_changes, change_set, load_changes, read_keyed, write_keyed
from tallybridge.operators.dimension import join_dimension
from tallybridge.operators.profile import profile_columns, profile_issues, profile_tables
from tallybridge.operators.profile_store import merge_profiles, read_profile, stored_profile
from tallybridge.plans.migration import Migration, migrate
from tallybridge.plans.reconcile import CheckFailed, check_rows, gate, key_differences
from tallybridge.plans.spec import load_spec, parse_spec
from tallybridge.plans.view_checks import check_exports, check_views
from tallybridge.plans.views import build_views, create_views

__all__ = [
    "CheckFailed",
    "Migration",
    "apply_changes",
    "apply_rules",
    "build_views",
    "change_set",
    "check_exports",
    "check_rows",
    "check_views",
    "create_views",
    "gate",
    "join_dimension",
    "key_differences",
    "load_changes",
    "load_spec",
    "merge_profiles",
    "migrate",
    "parse_spec",
    "profile_columns",
    "profile_issues",
    "profile_tables",
    "read_keyed",
    "read_profile",
    "register_rule",
    "stored_profile",
    "write_keyed",
]
