"""Chat formatting: links tool calls to their results, orders them, validates arguments, writes canonical JSON.

Calls and results meet by a hash join on (conversation, call id). A call may name others whose results it
needs by ``{"$ref": "<call id>"}`` in its arguments; it comes after all of them. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm.common import staged, table

# The schemas of the query's tools, field: (type, required, least, most).
SCHEMAS = {
    "search": {"query": ("string", True, 1, None), "limit": ("integer", False, 1, 50), "after": ("call", False, None, None)},
    "summarise": {"text": ("string", True, 1, None), "ratio": ("number", True, 0, 1), "after": ("call", False, None, None)},
    "translate": {"text": ("string", True, 1, None), "to": ("string", True, 2, 2), "formal": ("boolean", False, None, None), "after": ("call", False, None, None)},
}

_KINDS = {
    "string": lambda kind: kind == "STRING",
    "integer": lambda kind: kind == "BIGINT",
    "number": lambda kind: (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"),
    "boolean": lambda kind: kind == "BOOLEAN",
    "call": lambda kind: kind == "OBJECT<`$ref`: STRING>",
}


def canonical(json: Column) -> Column:
    """JSON text with keys sorted at every level, no white space and shortest numbers; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def quoted(text: Column) -> Column:
    """A string as JSON text."""
    return F.to_json(text.cast("variant"))


def argument_errors(name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, tuple]]) -> Column:
    """Sorted array of what is wrong with a call's arguments (JSON text) under the schema of its tool.

    Strings are bounded by their length, numbers by their value. Null fields count as missing.
    """
    value = F.try_parse_json(arguments)
    none = F.array().cast("array<string>")
    of_tool = F.array(F.lit("unknown tool"))
    for tool, fields in schemas.items():
        found = [
            F.transform(
                F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in fields])),
                lambda k: F.concat(F.lit("unknown field "), k),
            )
        ]
        for field, (kind, required, least, most) in fields.items():
            part = F.try_variant_get(value, f"$.{field}", "variant")
            shape = F.schema_of_variant(part)
            gone = part.isNull() | F.is_variant_null(part)
            wrong = []
            if required:
                wrong.append(F.when(gone, f"missing {field}"))
            fits = F.coalesce(_KINDS[kind](shape), F.lit(False))
            wrong.append(F.when(~gone & ~fits, f"{field} is no {kind}"))
            if least is not None or most is not None:
                text = F.try_variant_get(value, f"$.{field}", "string")
                size = F.length(text) if kind == "string" else text.try_cast("double")
                outside = F.lit(False)
                outside = outside | (size < least) if least is not None else outside
                outside = outside | (size > most) if most is not None else outside
                wrong.append(F.when(~gone & fits & outside, f"{field} is out of range"))
            found.append(F.array_compact(F.array(*wrong)))
        of_tool = F.when(name == tool, F.concat(*found)).otherwise(of_tool)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    return F.array_sort(F.when(~is_object, F.array(F.lit("arguments are no object"))).otherwise(F.coalesce(of_tool, none)))


def _merged(rows: DataFrame, by: list[str]) -> DataFrame:
    """Fully repeated rows as one with their number; of rows that share an id the first is marked."""
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    rank = F.struct(F.col("position"), F.xxhash64(*[c for c in rows.columns if c != "copies"]).alias("h"))
    rows = rows.withColumn("rank", rank)
    first = rows.groupBy(*by).agg(F.min("rank").alias("least"))
    return rows.join(first, by).withColumn("first", F.col("rank") == F.col("least")).drop("rank", "least")


def _order(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, order_key, order_hop): sorting a conversation's calls by both and by position puts every
    call after those it refers to, and leaves calls in place that refer to earlier ones only.

    The key is the largest position among a call and all it refers to, directly or not; the hop counts the steps
    from the call at that position. Where all references of a conversation point back, that is its own position and 0.
    Other conversations are worked off in rounds. In a round, calls with at most one reference to a call that is
    still open form chains, which are followed by doubling: a chain of n calls takes log n steps. Rounds
    are needed only where calls with several open references depend on each other. Calls in or behind a circle have no key.
    """
    keys = ["conv_id", "call_id"]
    ahead = staged(edges.where("parent_position >= position").select("conv_id").distinct(), "forward")
    plain = calls.join(ahead, "conv_id", "left_anti").select(*keys, F.col("position").alias("order_key"), F.lit(0).alias("order_hop"))
    if ahead.isEmpty():
        return plain
    own = F.struct(F.col("position").cast("long").alias("k"), F.lit(0).alias("h"))
    todo = staged(calls.join(ahead, "conv_id", "left_semi").select(*keys, own.alias("v")), "todo")
    edges = staged(edges.join(ahead, "conv_id", "left_semi").select(*keys, "parent"), "edges")
    done = []
    while True:
        waits = edges.groupBy(*keys).agg(F.count("*").alias("open"), F.min("parent").alias("parent"))
        chains = todo.join(waits, keys, "left").where("open is null or open = 1").select(*keys, "v", F.lit(1).alias("d"), "parent")
        chains = _follow(staged(chains, "chains"))
        new = staged(chains.where("parent is null").select(*keys, "v"), "ordered")
        if new.isEmpty():
            break
        done.append(new)
        todo = todo.join(new, keys, "left_anti")
        settled = new.select("conv_id", F.col("call_id").alias("parent"), F.struct("v.k", (F.col("v.h") + 1).alias("h")).alias("pv"))
        edges = edges.join(new.select(*keys), keys, "left_anti").join(settled, ["conv_id", "parent"], "left")
        edges = staged(edges, "edges")
        known = edges.where("pv is not null").groupBy(*keys).agg(F.max("pv").alias("pv"))
        todo = staged(todo.join(known, keys, "left").select(*keys, F.greatest("v", "pv").alias("v")), "todo")
        edges = edges.where("pv is null").drop("pv")
    for new in done:
        plain = plain.unionByName(new.select(*keys, F.col("v.k").alias("order_key"), F.col("v.h").alias("order_hop")))
    return plain


def _follow(chains: DataFrame) -> DataFrame:
    """Calls (conv_id, call_id, v, d, parent) with what their chains lead to: ``v`` is the largest (key, hop) over the ``d``
    calls from this one on, ``parent`` the call after them, null at the end. Each step doubles d."""
    keys = ["conv_id", "call_id"]
    steps = max(1, chains.count()).bit_length() + 1  # longer chains go round in a circle
    for _ in range(steps):
        next_ = chains.select("conv_id", F.col("call_id").alias("parent"), F.col("v").alias("nv"), F.col("d").alias("nd"), F.col("parent").alias("np"))
        joined = chains.join(next_, ["conv_id", "parent"], "left")
        further = F.struct("nv.k", (F.col("nv.h") + F.col("d")).alias("h"))
        moved = F.col("nd").isNotNull()
        chains = staged(
            joined.select(
                *keys,
                F.when(moved, F.greatest("v", further)).otherwise(F.col("v")).alias("v"),
                F.when(moved, F.col("d") + F.col("nd")).otherwise(F.col("d")).alias("d"),
                F.when(moved, F.col("np")).otherwise(F.col("parent")).alias("parent"),
                moved.alias("moved"),
            ),
            "chains",
        )
        more = not chains.where("moved and parent is not null").isEmpty()
        chains = chains.drop("moved")
        if not more:
            break
    return chains


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, tuple]]) -> DataFrame:
    """One row for each distinct call and for each distinct result that no call asked for.

    ``calls`` (conv_id, call_id, position, name, arguments) and ``results`` (conv_id, call_id, position, content);
    other columns are ignored. ``status`` is ``linked``, ``no_result``, ``orphan_result``, ``duplicate_call`` or
    ``duplicate_result`` (the first by position stands; full repeats are one row with ``copies``). A row
    whose conversation or id is null is linked to nothing. ``errors`` joins what is wrong with the arguments;
    ``message`` is canonical JSON of the call and its result. ``order_key`` and ``order_hop``: see ``_order``; null
    for rows that don't stand and for references in a circle.
    """
    keys = ["conv_id", "call_id"]
    calls = staged(_merged_or_null(calls.select(*keys, "position", "name", "arguments"), keys), "calls")
    results = staged(_merged_or_null(results.select(*keys, "position", "content"), keys), "results")
    standing = calls.where("first").select(*keys, "position", "arguments")
    pattern = F.lit(r'"\$ref":"((?:[^"\\]|\\.)*)"')
    refs = F.regexp_extract_all(canonical(F.col("arguments")), pattern, F.lit(1))
    unescaped = F.transform(refs, lambda r: F.get(F.from_json(F.concat(F.lit('["'), r, F.lit('"]')), "array<string>"), 0))
    refs = F.array_distinct(unescaped)
    refs = standing.select(*keys, "position", F.explode(refs).alias("parent"))
    targets = standing.select("conv_id", F.col("call_id").alias("parent"), F.col("position").alias("parent_position"))
    refs = staged(refs.join(targets, ["conv_id", "parent"], "left"), "references")
    lost = refs.where("parent_position is null").groupBy(*keys).agg(F.array_sort(F.collect_set(F.concat(F.lit("unknown reference "), "parent"))).alias("lost"))
    order = staged(_order(standing, refs.where("parent_position is not null")), "order")

    kept = results.where("first").select(*keys, F.col("content"), F.lit(True).alias("answered"))
    linked = calls.where("first").join(kept, keys, "left").join(lost, keys, "left").join(order, keys, "left")
    linked = linked.withColumn("status", F.when(F.col("answered"), "linked").otherwise("no_result"))
    extra = calls.where("not first").withColumn("status", F.lit("duplicate_call"))
    loose = results.join(standing.select(*keys, F.lit(True).alias("asked")), keys, "left")
    loose = loose.where("asked is null or not first")
    loose = loose.withColumn("status", F.when(F.col("first"), "orphan_result").otherwise("duplicate_result"))
    rows = linked.unionByName(extra, allowMissingColumns=True).unionByName(loose, allowMissingColumns=True)
    wrong = F.concat(argument_errors(F.col("name"), F.col("arguments"), schemas), F.coalesce("lost", F.array().cast("array<string>")))
    wrong = F.when(F.col("status").endswith("result") & F.col("name").isNull() & (F.col("status") != "no_result"), F.lit("")).otherwise(F.array_join(wrong, "; "))
    parts = [
        F.concat(F.lit('"arguments":'), canonical(F.col("arguments"))),
        F.concat(F.lit('"id":'), quoted(F.col("call_id"))),
        F.concat(F.lit('"name":'), quoted(F.col("name"))),
        F.concat(F.lit('"result":'), quoted(F.col("content"))),
    ]
    message = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return rows.select(
        *keys, "position", "name", "status", "copies", "order_key", "order_hop", wrong.alias("errors"), message.alias("message")
    )


def _merged_or_null(rows: DataFrame, keys: list[str]) -> DataFrame:
    """As ``_merged``; rows with a null key are kept as first of their own."""
    whole = _merged(rows.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()), keys)
    rest = rows.where(F.col(keys[0]).isNull() | F.col(keys[1]).isNull())
    rest = rest.groupBy(*rows.columns).agg(F.count("*").alias("copies")).withColumn("first", F.lit(True))
    return whole.unionByName(rest)


def calls_of(turns: DataFrame) -> DataFrame:
    """The query's tool calls: what a user asks at a turn is a call of one of three tools.

    Conversations whose id is divisible by 5 put their calls in reverse order, so that references point ahead.
    """
    asked = turns.where("role = 'user'")
    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    back = F.col("conv_id") % 5 == 0
    n = F.length(text)
    name = F.element_at(F.array(F.lit("search"), F.lit("translate"), F.lit("summarise")), (turn % 3 + 1).cast("int"))
    after = F.when(turn >= 2, F.concat(F.lit(', "after": {"$ref": "c'), (turn - 2).cast("string"), F.lit('"}')))
    after = F.coalesce(after, F.lit(""))
    search = F.concat(F.lit('{"query": '), quoted(text), F.lit(', "limit": '), (n % 60).cast("string"), after, F.lit("}"))
    to = F.when(n % 7 == 0, "").otherwise(F.when(n % 2 == 0, "en").otherwise("de"))
    translate = F.concat(F.lit('{ "to": '), quoted(to), F.lit(', "text":'), quoted(text), F.lit(', "formal": '), F.when(n % 11 == 0, '"yes"').otherwise("true"), after, F.lit(" }"))
    summarise = F.concat(F.lit('{"text":'), quoted(text), F.lit(', "size": 1'), after, F.lit(', "ratio": 0.'), (n % 10).cast("string"), F.lit("5}"))
    arguments = F.when(name == "search", search).when(name == "translate", translate).otherwise(summarise)
    position = F.when(back, 1000 - turn).otherwise(turn).alias("position")
    return asked.select("conv_id", F.concat(F.lit("c"), turn.cast("string")).alias("call_id"), position, name.alias("name"), arguments.alias("arguments"))


def results_of(turns: DataFrame) -> DataFrame:
    """The query's results: what the assistant answers at a turn belongs to the call of the turn before."""
    said = turns.where("role = 'assistant'")
    call = F.concat(F.lit("c"), (F.col("turn") - 1).cast("string"))
    return said.select("conv_id", call.alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations' turns as tool calls and results, linked, ordered, validated and written as canonical JSON."""
    turns = table(spark, sf_dir, "conversations")
    return link_tool_calls(calls_of(turns), results_of(turns), SCHEMAS)


OP10_SQL = r"""
WITH asked AS (
  SELECT conv_id, turn, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    conv_id % 5 = 0 AS back, CASE turn % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'translate' ELSE 'summarise' END AS name
  FROM conversations WHERE role = 'user'
), answer AS (
  SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'
), calls AS (
  SELECT q.*, CASE WHEN q.back THEN 1000 - q.turn ELSE q.turn END AS position, p.turn IS NOT NULL AS has_parent, q.turn >= 2 AS has_ref
  FROM asked q LEFT JOIN asked p ON p.conv_id = q.conv_id AND p.turn = q.turn - 2
), chain AS (
  SELECT c.*, (SELECT min(d.turn) FROM asked d WHERE d.conv_id = c.conv_id AND d.turn <= c.turn AND d.turn % 2 = c.turn % 2
      AND (SELECT count(*) FROM asked e WHERE e.conv_id = c.conv_id AND e.turn % 2 = c.turn % 2 AND e.turn BETWEEN d.turn AND c.turn)
        = (c.turn - d.turn) // 2 + 1) AS head
  FROM calls c
), said AS (
  SELECT c.*, a.turn IS NOT NULL AS answered, a.text AS content,
    CASE WHEN has_ref THEN '"after":{"$ref":"c' || (c.turn - 2) || '"},' ELSE '' END AS after
  FROM chain c LEFT JOIN answer a ON a.conv_id = c.conv_id AND a.turn = c.turn + 1
), formed AS (
  SELECT *, CASE name
      WHEN 'search' THEN '{' || after || '"limit":' || (n % 60) || ',"query":' || to_json(text) || '}'
      WHEN 'translate' THEN '{' || after || '"formal":' || CASE WHEN n % 11 = 0 THEN '"yes"' ELSE 'true' END || ',"text":' || to_json(text)
        || ',"to":"' || CASE WHEN n % 7 = 0 THEN '' WHEN n % 2 = 0 THEN 'en' ELSE 'de' END || '"}'
      ELSE '{' || after || '"ratio":0.' || (n % 10) || '5,"size":1,"text":' || to_json(text) || '}' END AS arguments,
    CASE name
      WHEN 'search' THEN list_filter([CASE WHEN n % 60 < 1 OR n % 60 > 50 THEN 'limit is out of range' END, CASE WHEN n = 0 THEN 'query is out of range' END], lambda x: x IS NOT NULL)
      WHEN 'translate' THEN list_filter([CASE WHEN n % 11 = 0 THEN 'formal is no boolean' END, CASE WHEN n = 0 THEN 'text is out of range' END, CASE WHEN n % 7 = 0 THEN 'to is out of range' END], lambda x: x IS NOT NULL)
      ELSE list_filter([CASE WHEN n = 0 THEN 'text is out of range' END, 'unknown field size'], lambda x: x IS NOT NULL) END AS errors
  FROM said
)
SELECT conv_id, 'c' || turn AS call_id, position, name, CASE WHEN answered THEN 'linked' ELSE 'no_result' END AS status, 1::BIGINT AS copies,
  CASE WHEN back THEN 1000 - head ELSE position END::BIGINT AS order_key,
  CASE WHEN back THEN (turn - head) // 2 ELSE 0 END::INTEGER AS order_hop,
  array_to_string(errors || CASE WHEN has_ref AND NOT has_parent THEN ['unknown reference c' || (turn - 2)] ELSE [] END, '; ') AS errors,
  '{"arguments":' || arguments || ',"id":"c' || turn || '","name":"' || name || '"' || CASE WHEN content IS NULL THEN '' ELSE ',"result":' || to_json(content) END || '}' AS message
FROM formed
UNION ALL
SELECT a.conv_id, 'c' || (a.turn - 1), a.turn, NULL, 'orphan_result', 1, NULL, NULL, '',
  '{"id":"c' || (a.turn - 1) || '"' || CASE WHEN a.text IS NULL THEN '' ELSE ',"result":' || to_json(a.text) END || '}'
FROM answer a LEFT JOIN asked q ON q.conv_id = a.conv_id AND q.turn = a.turn - 1 WHERE q.conv_id IS NULL
"""
