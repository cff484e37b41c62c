"""License scan over a positional index of rare licence words.

Every word of the templates that occurs in a document is kept with its position. Over the corpus these words get an
inverse document frequency. A document's rarest licence words tell which templates it can have; the positions of their words,
less their offset in the template, must agree on where it starts; the key phrase is then verified there, and the rest weighed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, landed

#: Characters that part words, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """`words` of a licence text. It is found where all words of `key` stand, and words with `share` of the weight.

    A template without `key` is found only whole."""

    label: str
    words: str
    key: str = ""
    share: float = 1.0


# The phrases that count as base matches.
PHRASES = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)

# Well-known wording of public licences.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted", 0.7),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license", 0.8),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3", 0.7),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2", 0.7),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms", 0.7),
    Template("mpl-2", "mozilla public license version 2", "mozilla public license", 0.8),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee", 0.7),
    Template("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "creative commons attribution sharealike", "creative commons attribution sharealike"),
    Template("cc0", "dedicated to the public domain under cc0", "public domain under cc0", 0.7),
)


def _rows(spark, values: list[tuple], names: str) -> DataFrame:
    """A few constant rows."""
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names.split(), strict=True)]) for r in values]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan(
    docs: DataFrame,
    phrases: tuple[Template, ...] = PHRASES,
    templates: tuple[Template, ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of `docs`: its id, n_words, n_base (places of `phrases`), first_word and last_word (their
    smallest and largest start), base_labels, labels, score, and `places`: label, start and length of all that was found.

    score is 1 where a phrase stands, else the largest share of a template's weight found at one start, 0 without any.
    A null or empty text has no words: zeros, empty labels, null positions. Equal rows each get a row; other columns
    are ignored. An empty table gives an empty one.

    A file's licence words are looked up, the rarest first: a template without all words of its key phrase among them is
    out, which the first, rarest word settles for nearly all. The positions of the others' words, less their places in the
    template, are starts; words that agree on one are counted and weighed there. Only positions in files with a template left are
    shuffled, a row for each start and word, so the work on a text grows with its length however often it repeats itself.
    """
    every = (*phrases, *templates)
    vocabulary = sorted({w for t in every for w in t.words.split()})
    number = {w: i for i, w in enumerate(vocabulary)}
    cut = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), SEPARATORS), "")
    term = F.create_map(*[x for w, i in number.items() for x in (F.lit(w), F.lit(i))])

    def hit(w: Column, i: Column) -> Column:
        return F.struct(w.alias("word"), i.alias("at"))

    words = docs.select(F.col(id_col).alias("id"), cut.alias("words"))
    found = F.filter(F.transform("words", hit), lambda x: x["word"].isin(vocabulary))
    found = F.transform(found, lambda x: F.struct(term[x["word"]].alias("term"), x["at"].alias("at")))
    thin = words.select("id", F.size("words").cast("long").alias("n_words"), found.alias("hits"))
    hits = landed(thin.withColumn("row", F.monotonically_increasing_id()), "licence-words")

    n = hits.count()
    counts = hits.select(F.explode(F.array_distinct("hits.term")).alias("term")).groupBy("term").count().collect()
    seen = {r["term"]: r["count"] for r in counts}  # one entry for each template word
    idf = {w: math.log((1 + n) / (1 + seen.get(i, 0))) + 1 for w, i in number.items()}

    def key_places(t: Template) -> range:
        """Where in the template its key phrase stands; all of it without one."""
        all_, key = t.words.split(), t.key.split()
        first = next(i for i in range(len(all_)) if all_[i : i + len(key)] == key)
        return range(first, first + len(key)) if key else range(len(all_))

    def left_in(t: Template) -> Column:
        """Whether the file has all words of the key phrase; the rarest is asked for first."""
        asked = sorted({t.words.split()[k] for k in key_places(t)}, key=lambda w: (-idf[w], w))
        out = F.lit(True)
        for w in reversed(asked):
            out = F.when(F.array_contains("terms", number[w]), out).otherwise(False)
        return out

    # postings: for each word of a template its place there, its weight, and whether it is one of the key phrase
    postings = [
        (number[w], i, k, idf[w], int(k in key_places(t))) for i, t in enumerate(every) for k, w in enumerate(t.words.split())
    ]
    spark = docs.sparkSession
    postings = F.broadcast(_rows(spark, postings, "term template offset weight key"))
    about = [
        (i, i < len(phrases), bool(t.key), t.label, len(t.words.split()), len(key_places(t)), sum(idf[w] for w in t.words.split()), t.share * 0.999)
        for i, t in enumerate(every)
    ]
    about = F.broadcast(_rows(spark, about, "template base keyed label length keys total least"))

    open_ = hits.withColumn("terms", F.array_distinct("hits.term"))
    open_ = open_.withColumn("left", F.array_compact(F.array(*[F.when(left_in(t), F.lit(i)) for i, t in enumerate(every)])))
    open_ = open_.filter(F.size("left") > 0).select("row", "left", F.explode("hits").alias("hit")).select("row", "left", "hit.term", "hit.at")
    starts = open_.join(postings, "term").filter(F.array_contains("left", F.col("template")))
    starts = starts.groupBy("row", "template", (F.col("at") - F.col("offset")).alias("start")).agg(
        F.sum("key").alias("found"), F.count(F.lit(1)).alias("words"), F.sum("weight").alias("weight")
    )
    starts = starts.join(about, "template").filter(F.col("found") == F.col("keys"))
    share = F.when(F.col("words") == F.col("length"), 1.0).otherwise(F.least(F.lit(1.0), F.round(F.col("weight") / F.col("total"), 12)))
    starts = starts.withColumn("share", share)
    place = F.struct("label", "start", "length", "share")
    told = F.col("share") >= F.col("least")
    placed = starts.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), place))).alias("base"),
        F.sort_array(F.collect_list(F.when(~F.col("base") & told, place))).alias("more"),
        F.max(F.when(F.col("keyed"), F.col("share")).otherwise(0.0)).alias("near"),
    )
    empty = F.array().cast("array<struct<label:string,start:int,length:int,share:double>>")
    rows = hits.select("row", "id", "n_words").join(placed, "row", "left")
    rows = rows.withColumns({"base": F.coalesce("base", empty), "more": F.coalesce("more", empty)})

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(labels)), ",")

    at = F.col("base.start")
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat(F.col("base.label"), F.col("more.label"))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("near", F.lit(0.0))).alias("score"),
        F.concat("base", "more").alias("places"),
    )
