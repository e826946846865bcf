"""Tool-call linking for chat data, with DataFrame functions only.

``link_calls`` takes calls (call_id, conv_id, tool, arguments as JSON, after_id: the call whose result must come first, or
null) and results (call_id, conv_id, content), and

1. reduces each identifier to one call and one result (the least by content, with counts, by partial
   aggregation: identifiers met very often are no hot keys and no cross products); ``conflict`` says that the calls, or
   the results, of an identifier differ,
2. joins calls and results by identifier, keeping calls without result and results without call,
3. orders calls topologically: their step is 1 + that of the call they follow, found by pointer doubling, i.e. in
   log2(longest chain) joins; calls on or behind a cycle have no step,
4. parses the arguments once and validates them against the tool's schema, and
5. serialises one canonical JSON object a call: keys in order at every level, no blanks.

Calls and results may bring a column ``n``, the number of rows that one stands for.

A schema is a dict in JSON Schema's vocabulary: ``properties`` with ``type`` (string, integer, number, boolean, array,
object, null), ``minLength``, ``maxLength``, ``minimum``, ``maximum``, ``enum``; and ``required``. JSON nulls count as missing
where something is required. Arguments that aren't JSON (or repeat a key) are ``json``, and serialised as they stand.

The conversations table holds no tool messages, so ``from_conversations`` reads it as calls: every turn that is not
the assistant's calls the tool named after its role, and an assistant's turn is the result of the turn before it; a call
follows the call two turns before (its exchange comes first). A turn is identified by its conversation and number, but a
text that is itself a JSON object with an ``id`` keeps that id within its conversation; whoever follows or answers such a
turn is linked to the id it kept (of several calls in one turn, to the least id).

Edge cases: null conv_id or turn make no identifier, such rows are left out; null texts are missing arguments
(``missing:text``) or an empty content; empty texts violate ``minLength``; identifiers may repeat (n_calls, n_results count
all rows); an empty table yields no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covelake.llm.common import materialise

#: Of the tools that from_conversations makes.
SCHEMAS = {role: {"properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}, "required": ["text", "turn"]} for role in ("user", "system")}
_NUMBER = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def schema_error(parsed: Column, schema: dict) -> Column:
    """The first violation as ``kind:property`` (required first, then properties in order), or null, of parsed arguments."""
    checks = [(parsed.isNull(), "json"), (~F.schema_of_variant(parsed).startswith("OBJECT"), "type:arguments")]
    path = lambda k: "$['" + k + "']"
    kind_of = lambda k: F.schema_of_variant(F.try_variant_get(parsed, path(k), "variant"))
    for k in schema.get("required", []):
        checks.append((F.coalesce(kind_of(k), F.lit("VOID")) == "VOID", f"missing:{k}"))
    for k, rule in schema.get("properties", {}).items():
        kind, text, number = kind_of(k), F.try_variant_get(parsed, path(k), "string"), F.try_variant_get(parsed, path(k), "double")
        is_number, is_text = kind.rlike(_NUMBER), kind == "STRING"
        right = {
            "string": is_text, "integer": is_number & (number == F.floor(number)), "number": is_number, "boolean": kind == "BOOLEAN",
            "array": kind.startswith("ARRAY"), "object": kind.startswith("OBJECT"), "null": kind == "VOID",
        }
        if rule.get("type") in right:
            checks.append((~right[rule["type"]] & ((kind != "VOID") | F.lit(k not in schema.get("required", []))), f"type:{k}"))
        fails = {
            "minLength": lambda x, on=is_text, v=text: on & (F.length(v) < x), "maxLength": lambda x, on=is_text, v=text: on & (F.length(v) > x),
            "minimum": lambda x, on=is_number, v=number: on & (v < x), "maximum": lambda x, on=is_number, v=number: on & (v > x), "enum": lambda x, v=text: ~v.isin(*map(str, x)),
        }
        checks += [(f(rule[name]), f"{name}:{k}") for name, f in fails.items() if name in rule]
    return F.coalesce(*[F.when(c, F.lit(e)) for c, e in checks])


def steps(calls: DataFrame) -> DataFrame:
    """(call_id, step) by pointer doubling over (call_id, after_id); ids distinct. A missing predecessor counts as none."""
    up = calls.select(F.col("call_id").alias("up"))
    cur = calls.select("call_id", "after_id").join(up, F.col("after_id") == up["up"], "left").select("call_id", F.col("up").alias("ptr"), F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long").alias("hops"))
    cur = materialise(cur, "chain")
    for _ in range(64):
        open_ = cur.where("ptr is not null")
        if open_.isEmpty():
            break
        other = cur.select(F.col("call_id").alias("ptr"), F.col("ptr").alias("next"), F.col("hops").alias("more"))
        moved = cur.join(other, "ptr", "left").select("call_id", F.col("next").alias("ptr"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"))
        cur = materialise(moved, "chain")
        limit = cur.agg(F.count(F.lit(1)), F.max("hops")).first()
        if limit[1] is not None and limit[1] > limit[0]:  # only a cycle is longer than all calls
            cur = cur.withColumn("hops", F.when(F.col("ptr").isNull(), F.col("hops")))
            break
    return cur.select("call_id", (F.col("hops") + 1).alias("step"))


def _rows(df: DataFrame) -> Column:
    return F.sum("n") if "n" in df.columns else F.count(F.lit(1))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row an identifier: call_id, conv_id, tool, step, status, error, n_calls, n_results, conflict, canonical."""
    parsed = F.try_parse_json("arguments")
    calls = calls.withColumn("arguments", F.coalesce(F.to_json(parsed), "arguments", F.lit("")))
    call, result = F.struct("conv_id", "tool", "arguments", "after_id"), F.struct(F.col("conv_id").alias("r_conv"), F.coalesce("content", F.lit("")).alias("content"))
    one = calls.groupBy("call_id").agg(F.min(call).alias("c"), (~F.min(call).eqNullSafe(F.max(call))).alias("calls_differ"), _rows(calls).alias("n_calls")).select("call_id", "c.*", "n_calls", "calls_differ")
    got = results.groupBy("call_id").agg(F.min(result).alias("r"), (~F.min(result).eqNullSafe(F.max(result))).alias("results_differ"), _rows(results).alias("n_results"))
    got = got.select(F.col("call_id").alias("r_id"), "r.*", "n_results", "results_differ")
    one = materialise(one, "calls")
    both = one.join(got, F.col("call_id") == F.col("r_id"), "full_outer")
    both = both.join(steps(one).withColumnRenamed("call_id", "s_id"), F.col("call_id") == F.col("s_id"), "left").withColumn("parsed", parsed)
    error = F.when(F.col("call_id").isNull(), F.lit(None).cast("string"))
    for tool, schema in schemas.items():
        error = error.when(F.col("tool") == tool, schema_error(F.col("parsed"), schema))
    error = error.otherwise(F.lit("unknown:tool"))
    both = both.withColumn("error", error)
    status = F.when(F.col("call_id").isNull(), "orphan result").when(F.col("step").isNull(), "cycle").when(F.col("error").isNotNull(), "invalid").when(F.col("r_id").isNull(), "no result").otherwise("ok")
    canonical = F.to_json(F.struct(F.coalesce("arguments", F.lit("")).alias("arguments"), F.coalesce("call_id", "r_id").alias("id"), F.coalesce("tool", F.lit("")).alias("name"), F.coalesce("content", F.lit("")).alias("result")))
    zero, no = F.lit(0).cast("long"), F.lit(False)
    return both.select(
        F.coalesce("call_id", "r_id").alias("call_id"), F.coalesce("conv_id", "r_conv").alias("conv_id"), "tool", "step", status.alias("status"), "error",
        F.coalesce("n_calls", zero).alias("n_calls"), F.coalesce("n_results", zero).alias("n_results"),
        (F.coalesce("calls_differ", no) | F.coalesce("results_differ", no)).alias("conflict"), canonical.alias("canonical"),
    )


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of a table of turns (conv_id, turn, role, text)."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), "text").where("conv_id is not null and turn is not null")
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))  # repeated rows travel once
    ident = lambda what: F.concat_ws(":", F.col("conv_id").cast("string"), what.cast("string"))
    own = F.when(F.col("text").startswith("{"), F.try_variant_get(F.try_parse_json("text"), "$.id", "string"))
    rows = rows.withColumn("own", own)
    calls = rows.where("role <> 'assistant'").select(F.when(F.col("own").isNotNull(), ident(F.col("own"))).otherwise(ident(F.col("turn"))).alias("call_id"), "conv_id", "turn", F.col("role").alias("tool"), F.to_json(F.struct("text", "turn")).alias("arguments"), "n")
    called = calls.groupBy("conv_id", "turn").agg(F.min("call_id").alias("met"))
    before = lambda df, back: df.join(called.withColumn("turn", F.col("turn") + back), ["conv_id", "turn"], "left")
    results = before(rows.where("role = 'assistant'"), 1)
    answers = F.when(F.col("own").isNotNull(), ident(F.col("own"))).otherwise(F.coalesce("met", ident(F.col("turn") - 1)))
    return before(calls, 2).select("call_id", "conv_id", "tool", "arguments", F.col("met").alias("after_id"), "n"), results.select(answers.alias("call_id"), "conv_id", F.col("text").alias("content"), "n")


ORACLE = """
WITH RECURSIVE rows AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, text,
         CASE WHEN text LIKE '{%' AND json_valid(text) THEN json_extract_string(text, '$.id') END AS own
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
calls AS (SELECT conv_id || ':' || coalesce(own, turn::VARCHAR) AS call_id, conv_id, turn, role AS tool,
                 CASE WHEN text IS NULL THEN json_object('turn', turn) ELSE json_object('text', text, 'turn', turn) END::VARCHAR AS arguments
          FROM rows WHERE role <> 'assistant'),
called AS (SELECT conv_id, turn, min(call_id) AS met FROM calls GROUP BY conv_id, turn),
answers AS (SELECT r.conv_id || ':' || coalesce(r.own, substr(c.met, length(r.conv_id || ':') + 1), (r.turn - 1)::VARCHAR) AS r_id, r.conv_id, coalesce(r.text, '') AS content
            FROM rows r LEFT JOIN called c ON c.conv_id = r.conv_id AND c.turn = r.turn - 1 WHERE r.role = 'assistant'),
linked AS (SELECT c.*, coalesce(b.met, '') AS after_id, row(c.conv_id, c.tool, c.arguments, coalesce(b.met, '')) AS whole
           FROM calls c LEFT JOIN called b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2),
one AS (SELECT call_id, arg_min(conv_id, whole) AS conv_id, arg_min(tool, whole) AS tool, arg_min(arguments, whole) AS arguments,
               arg_min(after_id, whole) AS after_id, count(*) AS n_calls, count(DISTINCT whole) > 1 AS calls_differ FROM linked GROUP BY call_id),
results AS (SELECT r_id, min(conv_id) AS r_conv, min(content) AS content, count(*) AS n_results, count(DISTINCT content) > 1 AS results_differ FROM answers GROUP BY r_id),
stepped(call_id, step) AS (
  SELECT call_id, 1::BIGINT FROM one WHERE after_id NOT IN (SELECT call_id FROM one)
  UNION ALL SELECT o.call_id, s.step + 1 FROM stepped s JOIN one o ON o.after_id = s.call_id),
judged AS (SELECT one.*, step,
                  CASE WHEN tool NOT IN ('user', 'system') THEN 'unknown:tool'
                       WHEN json_extract_string(arguments, '$.text') IS NULL THEN 'missing:text'
                       WHEN length(json_extract_string(arguments, '$.text')) < 1 THEN 'minLength:text'
                       WHEN json_extract(arguments, '$.turn')::BIGINT < 0 THEN 'minimum:turn' END AS error
           FROM one LEFT JOIN stepped USING (call_id))
SELECT coalesce(call_id, r_id) AS call_id, coalesce(conv_id, r_conv) AS conv_id, tool, step,
       CASE WHEN call_id IS NULL THEN 'orphan result' WHEN step IS NULL THEN 'cycle' WHEN error IS NOT NULL THEN 'invalid' WHEN r_id IS NULL THEN 'no result' ELSE 'ok' END AS status,
       error, coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
       coalesce(calls_differ, false) OR coalesce(results_differ, false) AS conflict,
       to_json(struct_pack(arguments := coalesce(arguments, ''), id := coalesce(call_id, r_id), name := coalesce(tool, ''), result := coalesce(content, '')))::VARCHAR AS canonical
FROM judged FULL OUTER JOIN results ON call_id = r_id
"""
