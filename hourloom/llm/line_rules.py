"""Quality rules: repetition inside a document, and lines that many documents of one host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import landed, whole_row

SPACES = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MASKING = 20  # letters of a line whose digits are no part of it


def normalised(line: Column) -> Column:
    """Letters in lower case; whatever stands between them is one blank, so counters and dates don't tell lines apart.

    Lines without letters, and those with digits but fewer than MASKING letters or four for each digit, count as they stand."""
    letters = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))
    trimmed = F.regexp_replace(line, f"^{SPACES}|{SPACES}$", "")
    n = F.length(F.translate(letters, " ", ""))
    text = (n >= MASKING) & (n >= 4 * F.length(F.regexp_replace(line, r"\P{N}+", "")))
    return F.when(~line.rlike(r"\p{L}"), trimmed).when(~line.rlike(r"\p{N}"), letters).when(text, letters).otherwise(F.lower(trimmed))


def _repeat_words(order: str) -> Column:
    """Words in the windows of `order` (hash and position, sorted) that have an equal neighbour."""
    spot = F.filter(
        F.sequence(F.lit(0), F.size(order) - 1),
        lambda k: F.coalesce(F.get(F.col(order), k)["hash"] == F.get(F.col(order), k - 1)["hash"], F.lit(False))
        | F.coalesce(F.get(F.col(order), k)["hash"] == F.get(F.col(order), k + 1)["hash"], F.lit(False)),
    )
    places = F.sort_array(F.transform(spot, lambda k: F.get(F.col(order), k)["at"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(
        places,
        start,
        lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(WINDOW), i - a["last"])).alias("total")),
        lambda a: a["total"],
    )


def _host(name: str) -> Column:
    """The host as a value that is never null."""
    return F.coalesce(F.concat(F.lit("h"), F.col(name)), F.lit("none"))


def _counted(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """A row for each row of `docs`, numbered: its counts, and the hash and length of each of its lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(
        F.col(id_col).alias("id"), F.col(host_col).alias("host"), text.alias("text"), F.array_remove(F.split(text, SPACES), "").alias("words")
    )
    hashed = words.select(
        "id", "host", "text", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(A_WORD)).alias("lines"),
    )
    long = F.size("h") >= WINDOW
    none = F.array().cast("array<bigint>")
    windows = F.when(long, F.transform(F.sequence(F.lit(1), F.greatest(F.size("h") - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("h", i, WINDOW))))
    hashed = hashed.select(
        "id", "host", "text", "n", "lines", F.coalesce(windows, none).alias("w"),
        F.transform("lines", lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), F.length(x).alias("chars"))).alias("keys"),
    )
    # sorted only where a window repeats
    order = F.when(
        F.size(F.array_distinct("w")) < F.size("w"), F.sort_array(F.transform("w", lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
    )
    stats = hashed.select(
        "id", "host", F.md5("text").alias("digest"), "n", "keys", order.alias("order"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
    )
    stats = stats.withColumn("n_repeat_words", F.when(F.col("order").isNotNull(), _repeat_words("order")).otherwise(0)).drop("order")
    # landed once, so a row's number stays what it is
    return landed(stats.withColumn("row", F.monotonically_increasing_id()), "line-hashes")


def _lines_of_texts(stats: DataFrame) -> DataFrame:
    """host, digest and the hashes of the lines of every distinct text."""
    each = stats.select(_host("host").alias("host"), "digest", F.array_distinct("keys.line").alias("lines"))
    return each.groupBy("host", "digest").agg(F.first("lines").alias("lines"))


def common_lines(stats: DataFrame, min_docs: int) -> DataFrame:
    """host and hash of the lines above the limit, counted over distinct texts before and after the shuffle."""
    counts = _lines_of_texts(stats).select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    return landed(counts.filter(F.col("docs") > min_docs).select("host", "line"), "common-lines")


def rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = 20,
    repeat_percent: int = 30,
    min_docs: int = 10,
    keep_share: float = 0.2,
    broadcast_rows: int = 200_000,
) -> DataFrame:
    """One row for each row of `docs`: counts, base_failed, n_common_lines, common_share (of the characters, in lines
    that go) and kept.

    A line goes if more than `min_docs` distinct texts of its host hold it, however large the host is; a document is
    depleted if less than `keep_share` of its characters would stay. Equal texts of a host count once, so copies alone
    never make a line common. A null text has no words and lines; a null host is a host of its own. Equal rows each
    get a row, an empty table gives an empty one, other columns are ignored.

    Texts are read once, and only hashes of lines are shuffled. Common lines are broadcast up to `broadcast_rows`, joined
    by shuffle beyond.
    """
    stats = _counted(docs, id_col, text_col, host_col)
    common = common_lines(stats, min_docs)
    rows = stats.select("row", _host("host").alias("host"), F.explode("keys").alias("key")).withColumn("line", F.col("key.line"))
    small = common.count() <= broadcast_rows
    lost = rows.join(F.broadcast(common) if small else common, ["host", "line"])
    lost = lost.groupBy("row").agg(F.sum("key.chars").alias("lost"), F.count(F.lit(1)).alias("gone"))
    chars = F.coalesce(F.aggregate("keys", F.lit(0), lambda a, k: a + k["chars"]), F.lit(0))
    thin = stats.withColumn("chars", chars).drop("keys", "host", "digest").join(lost, "row", "left")
    lost_share = F.coalesce(F.col("lost") / F.when(F.col("chars") > 0, F.col("chars")), F.lit(0.0))
    failed = (F.col("n") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n"))
    return thin.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_words"),
        *[F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & (1 - lost_share >= keep_share)).alias("kept"),
        F.coalesce("gone", F.lit(0)).cast("long").alias("n_common_lines"),
        lost_share.alias("common_share"),
    )


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = 10, keep_share: float = 0.2
) -> DataFrame:
    """`docs` without the common lines of their host, and without the documents that these had depleted.

    Texts without such lines stay as they are, null ones too; so do other columns. A document meets only those common
    lines that it has.
    """
    stats = _counted(docs, id_col, text_col, host_col)
    held = _lines_of_texts(stats).select("host", "digest", F.explode("lines").alias("line"))
    listed = held.join(common_lines(stats, min_docs), ["host", "line"]).groupBy("host", "digest").agg(F.collect_list("line").alias("gone"))
    text = F.col("doc").getField(text_col)
    rows = docs.select(whole_row(docs).alias("doc"), _host(host_col).alias("host"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"))
    rows = rows.join(listed, ["host", "digest"], "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<bigint>")))
    rows = rows.withColumn("lines", F.split(F.coalesce(text, F.lit("")), "\n"))
    left = F.filter("lines", lambda x: ~(x.rlike(A_WORD) & F.array_contains("gone", F.xxhash64(normalised(x)))))
    rows = rows.withColumn("clean", F.when(F.size("gone") > 0, F.array_join(left, "\n")).otherwise(text))
    solid = [F.length(F.regexp_replace(c, "\n", "")) for c in (F.coalesce("clean", F.lit("")), F.coalesce(text, F.lit("")))]
    rows = rows.filter(solid[0] >= keep_share * solid[1])
    return rows.select(*[F.col("clean").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])
