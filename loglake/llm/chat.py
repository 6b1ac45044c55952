"""Chat formatting: typed content parts flattened into one training string per conversation.

A visitor turns each part of a turn into text: text parts are escaped, image, audio and
document parts become a placeholder `<type>` in their place, while their reference, the
number of tokens that the placeholder expands to and its place in the output are recorded
as an attachment. Placeholders aren't under the loss mask, whoever's turn they are in.

A turn is written `<turn ROLE>BODY</turn>` and a line feed. In roles and texts a backslash
is written `\\b`, `<` is `\\l` and `>` is `\\g`: angle brackets in the output are always the
template's, and as no other backslash occurs the escapes are undone by plain replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = "array<struct<type:string,text:string,ref:string,tokens:long>>"
NOTED = "struct<text:boolean,begin:long,length:long,type:string,placeholder:string,ref:string,tokens:long>"
#: Tokens that a placeholder stands for where the part doesn't say.
EXPANDED = {"image": 576, "audio": 250, "document": 1024}
END = "</turn>\n"


def escape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A turn's content as one text part; null is empty."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens")))


def _kind(part: Column) -> Column:
    """What a part is written as; unknown types count as documents."""
    return F.when(part["type"].isin("text", *EXPANDED), part["type"]).otherwise("document")


def visit(parts: Column) -> Column:
    """The pieces of a turn's body, one for each part in order: text, escaped, or a placeholder."""
    piece = lambda p: F.when(_kind(p) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<"), _kind(p), F.lit(">")))
    return F.transform(F.coalesce(parts, F.array().cast(PARTS)), piece)


def noted(parts: Column, pieces: Column) -> Column:
    """For each piece: text (whether it is one), begin in the body (from 0), length, and what a placeholder stands for: type as given, placeholder, ref, tokens."""
    sizes = lambda p: F.coalesce(p["tokens"], *[F.when(_kind(p) == k, F.lit(n).cast("long")) for k, n in EXPANDED.items()])
    whole = F.arrays_zip(F.coalesce(parts, F.array().cast(PARTS)).alias("p"), pieces.alias("x"))

    def next_(done: Column, z: Column) -> Column:
        n = F.length(z["x"]).cast("long")
        one = F.struct((_kind(z["p"]) == "text").alias("text"), done["at"].alias("begin"), n.alias("length"), z["p"]["type"].alias("type"), _kind(z["p"]).alias("placeholder"), z["p"]["ref"].alias("ref"), sizes(z["p"]).alias("tokens"))
        return F.struct((done["at"] + n).alias("at"), F.concat(done["all"], F.array(one.cast(NOTED))).alias("all"))

    return F.aggregate(whole, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{NOTED}>").alias("all")), next_)["all"]


def conversations(rows: DataFrame, parts: str | None = None, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, spans (the loss mask), attachments, expanded.

    rows: conv_id, turn, role, and text or an array column of typed parts. spans: start (from 1) and length in code
    points of the texts of `learn` turns, placeholders left out. attachments: type as given, placeholder, ref, tokens
    and start of each placeholder, in order; expanded: all their tokens. Rows are ordered by turn, equal turns by
    role and content; repeated rows are turns of their own. Null roles and texts are empty, a null conv_id is a
    conversation; other columns are ignored, very long texts stay whole, an empty table gives an empty one.

    A conversation is one string, so its rows meet in one task: that is the operator's result, not a choice. The
    window and the grouping share one shuffle, and the window streams over sorted rows.
    """
    from pyspark.sql import Window

    content = F.col(parts) if parts else text_part(F.col("text"))
    turns = rows.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), visit(content).alias("__x"), content.alias("__p"))
    turns = turns.select("conv_id", "turn", "role", F.concat_ws("", "__x").alias("body"), noted(F.col("__p"), F.col("__x")).alias("found"))
    opened = F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    at = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("body") - len(END) + 1
    turns = turns.withColumn("piece", F.concat(opened, F.col("body"), F.lit(END))).withColumn("start", at).withColumn("k", F.row_number().over(order))
    all_turns = F.array_sort(F.collect_list(F.struct("k", "piece", "start", (F.col("role") == learn).alias("learned"), "found")))
    grouped = turns.groupBy("conv_id").agg(all_turns.alias("t"))
    texts = F.transform(F.filter("t", lambda x: x["learned"]), lambda x: F.transform(F.filter(x["found"], lambda f: f["text"]), lambda f: F.struct((x["start"] + f["begin"]).alias("start"), f["length"].alias("length"))))
    held = F.transform("t", lambda x: F.transform(F.filter(x["found"], lambda f: ~f["text"]), lambda f: F.struct(f["type"].alias("type"), f["placeholder"].alias("placeholder"), f["ref"].alias("ref"), f["tokens"].alias("tokens"), (x["start"] + f["begin"]).alias("start"))))
    out = grouped.select("conv_id", F.size("t").cast("long").alias("n_turns"), F.concat_ws("", F.col("t.piece")).alias("formatted"), F.flatten(texts).alias("spans"), F.flatten(held).alias("attachments"))
    return out.withColumn("expanded", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def turns_of(formatted: Column) -> Column:
    """Read back from a formatted string: array of (role, text); placeholders stay as they are."""
    pieces = F.filter(F.split(formatted, "</turn>\n"), lambda x: x != "")
    edge = lambda x: F.locate(">", x)
    return F.transform(pieces, lambda x: F.struct(unescape(F.substring(x, F.lit(7), edge(x) - 7)).alias("role"), unescape(F.substring(x, edge(x) + 1, F.length(x))).alias("text")))


def learned_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int"), s["length"].cast("int"))))


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns, all read back from the formatted string and its loss mask."""
    back = formatted.select("conv_id", "formatted", turns_of(F.col("formatted")).alias("turns"), F.concat_ws("", learned_texts(F.col("formatted"), F.col("spans"))).alias("learned"), "attachments")
    said = F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: DuckDB SQL for digests(conversations(...)) with the two rows of HARD added.
ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), marked AS (
  SELECT *, length(role) + length(text) + 15
    + 1 * (length(role || text) - length(replace(role || text, '\', '')))
    + 1 * (length(role || text) - length(replace(role || text, '<', '')))
    + 1 * (length(role || text) - length(replace(role || text, '>', ''))) AS n,
    replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g') AS body
  FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
#: A conversation whose texts hold the template's own strings.
HARD = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def hard(spark: SparkSession) -> DataFrame:
    """The rows of HARD, as literals of the plan."""
    rows = [F.struct(*[F.lit(x) for x in r]).cast("struct<conv_id:long,turn:long,role:string,text:string>") for r in HARD]
    return spark.range(1).select(F.inline(F.array(*rows)))
