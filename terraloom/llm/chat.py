"""Chat formatting: tool calls linked to results, ordered, validated and serialised, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise

#: JSON schema types and the prefixes of Spark's names for what a variant holds.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",)}
#: Objects within objects are validated to this depth.
DEPTH = 4


def quoted(x: Column) -> Column:
    """x as a JSON string, or null."""
    s = F.to_json(F.struct(x.cast("string").alias("a")))
    return F.when(x.isNull(), F.lit("null")).otherwise(s.substr(F.lit(6), F.length(s) - 6))


def _unique(df: DataFrame, others: list[str]) -> DataFrame:
    """One row for each call_id, the least of its rows, with their number; counted before the shuffle."""
    best = df.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min(F.struct(*others)).alias("x"), F.count("*").alias("times"))
    return best.select("call_id", "x.*", "times")


def _chains(picked: DataFrame, rounds: int) -> DataFrame:
    """picked(call_id, on), on null at an end -> (call_id, level): the steps to the end of a call's chain, by pointer doubling;
    null where the chain has none."""
    ends = F.col("on").isNull()
    cur = picked.select("call_id", F.coalesce("on", "call_id").alias("anchor"), (~ends).cast("long").alias("dist"), ends.alias("done"))
    while rounds and cur.where("NOT done").limit(1).count():
        above = cur.select(F.col("call_id").alias("anchor"), F.col("anchor").alias("next"), F.col("dist").alias("more"), F.col("done").alias("ends"))
        moved = cur.where("NOT done").join(above, "anchor").select("call_id", F.col("next").alias("anchor"), (F.col("dist") + F.col("more")).alias("dist"), F.col("ends").alias("done"))
        cur = materialise(cur.where("done").unionByName(moved))
        rounds -= 1
    return cur.select("call_id", F.when(F.col("done"), F.col("dist")).alias("level"))


def levels(nodes: DataFrame) -> DataFrame:
    """nodes(call_id, depends array<string>) with unique ids -> (call_id, level): the longest way over dependencies
    to a call that has none among the nodes. Calls on a cycle, or behind one, have a null level.

    Each call picks one dependency, so that calls form chains, which pointer doubling measures in as many rounds as the longest
    has binary digits; then calls go over to a dependency that stands higher than the one picked, until there is none. That
    takes as many goes as ways differ in their picks (two or three for conversations), and at most the longest way.
    """
    nodes = materialise(nodes)
    edges = nodes.select("call_id", F.explode(F.array_distinct("depends")).alias("on"))
    edges = materialise(edges.join(nodes.select(F.col("call_id").alias("on")), "on", "left_semi"))
    picked = materialise(nodes.select("call_id").join(edges.groupBy("call_id").agg(F.max("on").alias("on")), "call_id", "left"))
    rounds, endless = nodes.count().bit_length() + 1, 1 << 62
    while True:
        found = materialise(_chains(picked, rounds))
        at = edges.join(found.select(F.col("call_id").alias("on"), F.coalesce("level", F.lit(endless)).alias("l")), "on")
        best = at.groupBy("call_id").agg(F.max(F.struct("l", "on")).alias("best"))
        higher = materialise(best.join(found, "call_id").where(F.col("level") < F.col("best.l") + 1).select("call_id", F.col("best.on").alias("new")))
        if not higher.limit(1).count():
            return found
        picked = materialise(picked.join(higher, "call_id", "left").select("call_id", F.coalesce("new", "on").alias("on")))


def _entries(value: Column, prefix: Column, depth: int) -> Column:
    """All fields of an object and of the objects in it, as structs (parent, path, value)."""
    fields = F.map_entries(value.cast("map<string,variant>"))
    path = lambda e: F.concat(prefix, e["key"])
    own = lambda e: F.array(F.struct(prefix.alias("parent"), path(e).alias("path"), e["value"].alias("value")))
    if depth == 1:
        return F.flatten(F.transform(fields, own))
    inner = lambda e: F.when(F.schema_of_variant(e["value"]).startswith("OBJECT"), _entries(e["value"], F.concat(path(e), F.lit(".")), depth - 1))
    none = F.array().cast("array<struct<parent: string, path: string, value: variant>>")
    return F.flatten(F.transform(fields, lambda e: F.concat(own(e), F.coalesce(inner(e), none))))


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """calls(name, arguments, ...) plus `args` (variant) and `problems` (sorted array<string>).

    schemas(name, fields array<struct<path, type, required, minimum, maximum, max_length>>), one row a name; the path of a
    field in an object in the arguments has a dot, and bounds may be null. Problems: not json, not an object, unknown
    tool, and for a path p missing:p, unknown:p, type:p, minimum:p, maximum:p, length:p. A field is missing only if the object
    it belongs in is there, and unknown only if the schema names fields of that object. Null arguments aren't JSON.
    """
    df = calls.join(schemas.withColumn("__tool", F.lit(True)), "name", "left").withColumn("args", F.try_parse_json("arguments"))
    is_object = F.schema_of_variant("args").startswith("OBJECT")
    df = df.withColumn("__found", F.when(is_object, _entries(F.col("args"), F.lit(""), DEPTH)))
    got, want = F.col("__found"), F.col("fields")
    parent = lambda s: F.regexp_replace(s["path"], "[^.]*$", "")
    paths = F.transform(got, lambda e: e["path"])
    label = lambda what, xs: F.transform(xs, lambda x: F.concat(F.lit(what), x["path"]))
    kind = lambda e: F.coalesce(F.schema_of_variant(e["value"]), F.lit("VOID"))
    there = lambda p: (p == "") | F.exists(got, lambda e: (F.concat(e["path"], F.lit(".")) == p) & kind(e).startswith("OBJECT"))
    fits = lambda s, e: F.array_max(F.array(*[(s["type"] == t) & F.array_max(F.array(*[kind(e).startswith(p) for p in ps])) for t, ps in TYPES.items()]))
    number = lambda e: F.try_variant_get(e["value"], "$", "double")
    size = lambda e: F.length(F.try_variant_get(e["value"], "$", "string"))
    wrong = lambda test: F.filter(want, lambda s: F.exists(got, lambda e: (e["path"] == s["path"]) & F.coalesce(test(s, e), F.lit(False))))
    found = F.concat(
        label("missing:", F.filter(want, lambda s: s["required"] & there(parent(s)) & ~F.array_contains(paths, s["path"]))),
        label("unknown:", F.filter(got, lambda e: F.exists(want, lambda s: parent(s) == e["parent"]) & ~F.exists(want, lambda s: s["path"] == e["path"]))),
        label("type:", wrong(lambda s, e: ~fits(s, e))),
        label("minimum:", wrong(lambda s, e: fits(s, e) & (number(e) < s["minimum"]))),
        label("maximum:", wrong(lambda s, e: fits(s, e) & (number(e) > s["maximum"]))),
        label("length:", wrong(lambda s, e: (s["type"] == "string") & (size(e) > s["max_length"]))),
    )
    problems = F.when(F.col("args").isNull(), F.array(F.lit("not json"))).when(~is_object, F.array(F.lit("not an object"))).when(F.col("__tool").isNull(), F.array(F.lit("unknown tool"))).otherwise(F.array_sort(found))
    return df.withColumn("problems", problems).drop("__tool", "__found", "fields")


def canonical(value: Column) -> Column:
    """A variant as JSON with keys in order, no blanks, and one spelling for equal numbers: whole ones as digits, others
    as the shortest decimal of their double."""
    as_double = lambda x: x.try_cast("double")
    whole = lambda x: (as_double(x) % 1 == 0) & (F.abs(as_double(x)) < 1e38)
    spelt = lambda x: F.when(whole(x), as_double(x).try_cast("decimal(38,0)").cast("string")).otherwise(as_double(x).cast("string"))
    number = lambda x: F.when(x.rlike("^-?[0-9]") & x.rlike("[.eE]"), spelt(x)).otherwise(x)
    numbers = lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit("(-?[0-9][0-9.eE+-]*|[^0-9-]+)"), F.lit(1)), number), "")
    # JSON text holds no raw control characters: two stand for escapes, so that every quote left ends or begins a string
    plain = F.replace(F.replace(F.to_json(value), F.lit("\\\\"), F.lit("\1")), F.lit('\\"'), F.lit("\2"))
    parts = F.transform(F.split(plain, '"', -1), lambda x, i: F.when(i % 2 == 0, numbers(x)).otherwise(x))
    return F.replace(F.replace(F.array_join(parts, '"'), F.lit("\2"), F.lit('\\"')), F.lit("\1"), F.lit("\\\\"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result: conv_id, turn, kind, call_id, name, linked, level, problems, json.

    calls(conv_id, turn, call_id, name, arguments, depends array<string>): depends names the calls whose results this one
    builds on. results(conv_id, turn, call_id, content). They are hash-joined by call_id. In topological
    order, by (conv_id, level, turn), each call stands before its result and after the results it builds on: calls have
    twice the level of levels(), results one more. An id used by several calls is linked by the least of them; all get the
    problem "duplicate id", as do results of one call. Null ids link to nothing; ids that aren't there are no dependency.
    json is canonical(), arguments parsed and written anew (null if they aren't JSON). Texts of any length are kept whole;
    repeated rows return each; other columns play no part; empty tables give no rows.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "depends")
    results = results.select("conv_id", "turn", "call_id", "content")
    call = validate(calls, schemas)
    seen = _unique(calls, ["conv_id", "turn", "name", "depends"])
    done = results.where("call_id IS NOT NULL").groupBy("call_id").agg(F.count("*").alias("answers"))
    order = levels(seen.select("call_id", "depends"))
    about = seen.select("call_id", F.col("name").alias("tool"), "times").join(order, "call_id", "left").join(done, "call_id", "left")
    about = materialise(about)
    call = call.join(about.drop("tool"), "call_id", "left")
    again = F.when(F.col("times") > 1, F.array(F.lit("duplicate id"))).otherwise(F.array().cast("array<string>"))
    body = F.concat(F.lit('{"arguments":'), F.coalesce(canonical(F.col("args")), F.lit("null")), F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), quoted(F.col("name")), F.lit(',"type":"call"}'))
    left = call.select("conv_id", "turn", F.lit("call").alias("kind"), "call_id", "name", F.col("answers").isNotNull().alias("linked"), (F.col("level") * 2).alias("level"), F.concat("problems", again).alias("problems"), body.alias("json"))
    res = results.join(about, "call_id", "left")
    more = F.concat(F.when(F.col("tool").isNull(), F.array(F.lit("no call"))).otherwise(F.array().cast("array<string>")), F.when(F.col("answers") > 1, F.array(F.lit("duplicate id"))).otherwise(F.array().cast("array<string>")))
    body = F.concat(F.lit('{"content":'), quoted(F.col("content")), F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"type":"result"}'))
    right = res.select("conv_id", "turn", F.lit("result").alias("kind"), "call_id", F.col("tool").alias("name"), F.col("times").isNotNull().alias("linked"), (F.col("level") * 2 + 1).alias("level"), more.alias("problems"), body.alias("json"))
    return left.unionByName(right)


def calls_of_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as calls and results. A user's turn calls `ask`, with its text and counts of it, and builds on the
    answer before it and on the conversation's first turn; an assistant's turn is the result of the turn before it; a
    system's turn calls `configure`."""
    at = lambda t: F.concat_ws(":", F.col("conv_id").cast("string"), t.cast("string"))
    known = turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != ""))
    mean = F.floor(F.length(text) * 100 / words).cast("long")
    mean = F.when(words > 0, F.concat(F.lit(',"mean":'), F.format_string("%d.%02d", F.floor(mean / 100).cast("long"), mean % 100))).otherwise("")
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    arguments = F.concat(F.lit('{"text":'), quoted(F.col("text")), F.lit(',"counts":{"words":'), words.cast("string"), mean, F.lit(',"lines":'), lines.cast("string"), F.lit("}}"))
    calls = known.where(F.col("role").isin("user", "system")).select("conv_id", "turn", at(F.col("turn")).alias("call_id"), F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"), arguments.alias("arguments"), F.when(F.col("turn") == 0, F.array().cast("array<string>")).otherwise(F.array(at(F.col("turn") - 2), at(F.lit(0)))).alias("depends"))
    results = known.where(F.col("role") == "assistant").select("conv_id", "turn", at(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


#: The fields of the two tools of calls_of_conversations(): path, type, required, minimum, maximum, longest.
FIELDS = (("text", "string", True, None, None, 400), ("counts", "object", True, None, None, None), ("counts.words", "integer", True, 1.0, 64.0, None), ("counts.mean", "number", True, None, 8.5, None), ("counts.lines", "integer", False, None, 3.0, None))


def schemas(df: DataFrame) -> DataFrame:
    """The two tools of calls_of_conversations()."""
    kinds = dict(path="string", type="string", required="boolean", minimum="double", maximum="double", max_length="int")
    fields = F.array(*[F.struct(*[F.lit(x).cast(kind).alias(c) for x, (c, kind) in zip(f, kinds.items())]) for f in FIELDS])
    return df.sparkSession.range(2).select(F.when(F.col("id") == 0, "ask").otherwise("configure").alias("name"), fields.alias("fields"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """link_tool_calls() over a table (conv_id, turn, role, text), problems joined by commas. Turns
    without an id or a number, or of other roles, have no call; null texts are JSON nulls."""
    calls, results = calls_of_conversations(turns)
    out = link_tool_calls(calls, results, schemas(turns))
    return out.withColumn("problems", F.array_join("problems", ","))


ORACLE = """
WITH RECURSIVE t AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c AS (SELECT conv_id, turn, conv_id || ':' || turn AS call_id, CASE role WHEN 'user' THEN 'ask' ELSE 'configure' END AS name, text, coalesce(text, '') AS s,
  CASE WHEN turn = 0 THEN [] ELSE [conv_id || ':' || (turn - 2), conv_id || ':0'] END AS depends, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM t WHERE role IN ('user', 'system')),
f AS (SELECT *, length(s) * 100 // greatest(n, 1) AS m, length(s) - length(replace(s, chr(10), '')) + 1 AS ln FROM c),
r AS (SELECT conv_id, turn, conv_id || ':' || (turn - 1) AS call_id, text FROM t WHERE role = 'assistant'),
u AS (SELECT call_id, min(name) AS name, min(depends) AS depends, count(*) AS times FROM c GROUP BY call_id),
a AS (SELECT call_id, count(*) AS answers FROM r GROUP BY call_id),
e AS (SELECT DISTINCT u.call_id, v.call_id AS dep FROM u, unnest(u.depends) AS x(dep) JOIN u v ON v.call_id = x.dep),
w AS (SELECT call_id, 0::BIGINT AS level FROM u UNION SELECT e.call_id, w.level + 1 FROM w JOIN e ON e.dep = w.call_id),
l AS (SELECT call_id, max(level) AS level FROM w GROUP BY call_id)
SELECT conv_id, turn, 'call' AS kind, f.call_id, f.name, answers IS NOT NULL AS linked, 2 * level AS level,
  concat_ws(',', CASE WHEN length(s) > 400 THEN 'length:text' END, CASE WHEN ln > 3 THEN 'maximum:counts.lines' END, CASE WHEN n > 0 AND m > 850 THEN 'maximum:counts.mean' END,
    CASE WHEN n > 64 THEN 'maximum:counts.words' END, CASE WHEN n < 1 THEN 'minimum:counts.words' END, CASE WHEN n = 0 THEN 'missing:counts.mean' END,
    CASE WHEN text IS NULL THEN 'type:text' END, CASE WHEN times > 1 THEN 'duplicate id' END) AS problems,
  '{"arguments":{"counts":{"lines":' || ln || CASE WHEN n > 0 THEN ',"mean":' || rtrim(rtrim(printf('%d.%02d', m // 100, m % 100), '0'), '.') ELSE '' END || ',"words":' || n || '},"text":' || coalesce(to_json(text)::VARCHAR, 'null')
    || '},"id":"' || f.call_id || '","name":"' || f.name || '","type":"call"}' AS json
FROM f JOIN u USING (call_id) LEFT JOIN l USING (call_id) LEFT JOIN a USING (call_id)
UNION ALL
SELECT conv_id, turn, 'result', r.call_id, u.name, u.times IS NOT NULL, 2 * level + 1,
  concat_ws(',', CASE WHEN u.call_id IS NULL THEN 'no call' END, CASE WHEN answers > 1 THEN 'duplicate id' END),
  '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"id":"' || r.call_id || '","type":"result"}'
FROM r LEFT JOIN u USING (call_id) LEFT JOIN l USING (call_id) LEFT JOIN a USING (call_id)"""
