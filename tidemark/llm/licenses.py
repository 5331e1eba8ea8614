"""License scan: phrases at exact places, and an exact set-similarity join with templates.

Base: places where the words of a known phrase stand one after the other in a text.

Method: text blocks are the lines of a text. A block matches a template when it holds at
least ``SHARE`` of the template's distinct words. The join finds every such block:

* the template words are ordered by their frequency in all blocks, rarest first;
* a template of size s that needs o = ceil(SHARE * s) words is indexed under its first
  s - o + 1 words only (prefix filter): a matching block holds one of them;
* blocks with fewer than o template-vocabulary words are dropped (length filter);
* a pair is dropped unless the words left after the first shared one can still reach o, on
  the template's and on the block's side (positional filter);
* what is left is verified by counting the shared words.

A notice may also be wrapped over lines. So runs of ``2 * STEP`` words that start every ``STEP``
words of a paragraph (text between blank lines) are blocks too, whatever lines they cross; with
``STEP`` twice the longest template, a notice with as many other words in it lies in one of
them whole. A run is no sentence, and unrelated lines may hold a template's words between them:
of a run, only template words in the template's order count (their longest common subsequence).
They go through the same join; the order is verified on what it leaves.

The templates are a fixed, small vocabulary, so their index is broadcast; block words are
cut to that vocabulary before anything is exploded. Only candidate blocks are shuffled,
and they are combined per text in the map tasks. All steps are column expressions.

Edge cases: null and empty texts have no words and no labels; rows are matched to their
labels by id and digest of the text, so repeated ids and null ids are safe and repeated rows
get equal labels; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import Scratch, lower_ascii
from tidemark.llm.quality import let

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = (9, 10)

# Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences by which texts are put under a license, and their labels.
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain cc0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def word_line(text: Column) -> Column:
    """The words of a text in lower case, joined by single blanks."""
    return F.trim(F.regexp_replace(lower_ascii(text), GAP, " "))


def count_words(line: Column) -> Column:
    """Number of words of a line that ``word_line`` gave."""
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def places(line: Column, n_words: Column, phrase: str) -> Column:
    """Count, first and last start of a phrase, as a struct; starts are word numbers."""
    width = len(phrase.split())
    none = F.lit(None).cast("long")
    # Every word gets a blank of its own on both sides, so neighbouring places do not share one.
    padded = F.concat(F.lit(" "), F.replace(line, F.lit(" "), F.lit("  ")), F.lit(" "))
    mark = "  ".join(phrase.split())
    parts = let(F.split(padded, f" {mark} "), lambda p: F.struct(
        (F.size(p) - 1).cast("long").alias("n"),
        spaced_words(p[0]).cast("long").alias("first"),
        (n_words - spaced_words(F.element_at(p, -1)) - width).cast("long").alias("last"),
    ))
    empty = F.struct(F.lit(0).cast("long").alias("n"), none.alias("first"), none.alias("last"))
    return F.when(F.contains(padded, F.lit(f" {mark} ")), parts).otherwise(empty)


def spaced_words(padded: Column) -> Column:
    """Number of words in a text in which each has a blank on either side."""
    return ((F.length(padded) - F.length(F.replace(padded, F.lit(" "), F.lit("")))) / 2).cast("long")


def base_scan(docs: DataFrame) -> DataFrame:
    """doc_id, digest and text with n_words, n_base, first_word, last_word and base_labels."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256)).withColumn("line", word_line(F.col("text")))
    rows = rows.withColumn("n_words", count_words(F.col("line")).cast("long"))
    found = {p: f"p{i}" for i, p in enumerate(PHRASES)}
    rows = rows.withColumns({c: places(F.col("line"), F.col("n_words"), p) for p, c in found.items()})
    labels = F.array(*[F.when(F.col(c)["n"] > 0, PHRASES[p]) for p, c in found.items()])
    return rows.select(
        "doc_id",
        "digest",
        "n_words",
        reduce(lambda a, b: a + b, [F.col(c)["n"] for c in found.values()]).alias("n_base"),
        F.least(*[F.col(c)["first"] for c in found.values()]).alias("first_word"),
        F.greatest(*[F.col(c)["last"] for c in found.values()]).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(labels))).alias("base"),
    )


def template_words() -> list[tuple[int, str, list[str]]]:
    return [(i, label, list(dict.fromkeys(text.split()))) for i, (label, text) in enumerate(TEMPLATES)]


def needed(size: int) -> int:
    return -(-SHARE[0] * size // SHARE[1])


def vocabulary() -> list[str]:
    return sorted({w for _, _, words in template_words() for w in words})


STEP = 2 * max(len(text.split()) for _, text in TEMPLATES)


def telling_words() -> list[str]:
    """Of each template as many of its longest words as leave too few others for a match."""
    found = set()
    for _, _, words in template_words():
        found.update(sorted(words, key=lambda w: (-len(w), w))[: len(words) - needed(len(words)) + 1])
    return sorted(found)


def wrapped_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, digest, template words and ``run``, all words in order, of runs that may match.

    Runs are made and judged inside one generator, so each is cut and intersected once; the
    templates are only tried on runs that hold a telling word.
    """
    text = F.coalesce("text", F.lit(""))
    parts = F.filter(F.split(lower_ascii(text), r"\n[ \t\r]*\n"), lambda p: F.contains(p, F.lit("\n")))
    rows = docs.filter(F.contains(text, F.lit("\n"))).select("doc_id", F.sha2(text, 256).alias("digest"), F.explode(parts).alias("part"))
    rows = rows.select("doc_id", "digest", F.split(word_line(F.col("part")), " ").alias("all"))
    known, telling = (F.array(*map(F.lit, words)) for words in (vocabulary(), telling_words()))
    least = min(needed(len(words)) for _, _, words in template_words())

    def may_match(words: Column) -> Column:
        enough = [F.size(F.array_intersect(words, F.array(*map(F.lit, t)))) >= needed(len(t)) for _, _, t in template_words()]
        return (F.size(words) >= least) & F.arrays_overlap(words, telling) & reduce(lambda a, b: a | b, enough)

    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - STEP - 1, F.lit(0)), F.lit(STEP))
    cut = F.transform(starts, lambda at: F.slice("all", at + 1, 2 * STEP))
    runs = F.transform(cut, lambda run: F.struct(F.array_intersect(run, known).alias("words"), run.alias("run")))
    runs = F.filter(runs, lambda r: may_match(r["words"]))
    return rows.select("doc_id", "digest", F.explode(runs).alias("r")).select("doc_id", "digest", "r.words", "r.run")


def in_order() -> Column:
    """Length of the longest common subsequence of ``run`` and the template.

    Bit i of ``masks[w]`` marks the template's word i; bits of the running value that
    turn to zero are words found in order (bit-parallel method).
    """

    def step(v: Column, word: Column) -> Column:
        m = F.coalesce(F.try_element_at("masks", word), F.lit(0).cast("long"))
        hit = v.bitwiseAND(m)
        return (v + hit).bitwiseOR(v - hit).bitwiseAND(F.col("low"))

    return F.col("size") - F.bit_count(F.aggregate("run", F.col("low"), step))


def text_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, digest, template words and ``run`` (null: a line) of each block that may match.

    The length filter: fewer template words than the least template needs cannot match.
    """
    least = min(needed(len(words)) for _, _, words in template_words())
    known = F.array(*[F.lit(w) for w in vocabulary()])
    text = F.coalesce("text", F.lit(""))
    blocks = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.explode(F.split(lower_ascii(F.col("text")), "\n")).alias("line")
    )
    words = F.array_intersect(F.split(F.regexp_replace("line", GAP, " "), " "), known)
    lines = (
        blocks.select("doc_id", "text", words.alias("words"))
        .filter(F.size("words") >= least)
        .select("doc_id", F.sha2("text", 256).alias("digest"), "words", F.lit(None).cast("array<string>").alias("run"))
    )
    return lines.unionByName(wrapped_blocks(docs))


def ordered_templates(blocks: DataFrame) -> list[dict]:
    """The templates with their words in the order of their frequency in all blocks.

    The counts are those of a fixed vocabulary: their number does not grow with the data.
    """
    counted = blocks.select(F.explode("words").alias("word")).groupBy("word").count().collect()
    seen = {r["word"]: r["count"] for r in counted}
    out = []
    for i, label, words in template_words():
        masks = {w: 1 << k for k, w in enumerate(words)}
        ranked = sorted(words, key=lambda w: (seen.get(w, 0), w))
        out.append({"template": i, "label": label, "words": ranked, "size": len(ranked), "needed": needed(len(ranked)), "masks": masks})
    rank = {w: i for i, w in enumerate(sorted(vocabulary(), key=lambda w: (seen.get(w, 0), w)))}
    return [t | {"rank": rank} for t in out]


def matches(blocks: DataFrame) -> DataFrame:
    """doc_id, digest, label and share of every block that reaches a template."""
    spark = blocks.sparkSession
    templates = ordered_templates(blocks)
    ranks = F.create_map(*[F.lit(x) for w, i in templates[0]["rank"].items() for x in (w, i)])
    index = [
        (w, at, t["template"], t["label"], t["words"], t["size"], t["needed"], t["masks"], (1 << t["size"]) - 1)
        for t in templates
        for at, w in enumerate(t["words"][: t["size"] - t["needed"] + 1])
    ]
    prefixes = spark.createDataFrame(
        index, "word string, at int, template int, label string, template_words array<string>, size int, needed int, masks map<string,long>, low long"
    )
    ranked = F.transform(F.array_sort(F.transform("words", lambda w: F.struct(ranks[w].alias("r"), w.alias("w")))), lambda s: s["w"])
    rows = blocks.select("doc_id", "digest", "run", ranked.alias("words"))
    rows = rows.select("*", F.posexplode("words").alias("place", "word"))
    left = F.least(F.col("size") - F.col("at"), F.size("words") - F.col("place"))
    # All words before the first shared one are unshared; later prefix words give the same pair again.
    earlier = F.size(F.array_intersect(F.slice("template_words", 1, F.col("at")), F.slice("words", 1, F.col("place"))))
    shared = F.size(F.array_intersect("words", "template_words"))
    return (
        rows.join(F.broadcast(prefixes), "word")
        .filter((F.size("words") >= F.col("needed")) & (left >= F.col("needed")))
        .filter(earlier == 0)
        .withColumn("shared", shared)
        .filter(F.col("shared") >= F.col("needed"))
        .withColumn("shared", F.when(F.col("run").isNull(), F.col("shared")).otherwise(in_order()))
        .filter(F.col("shared") >= F.col("needed"))
        .select("doc_id", "digest", "label", (F.col("shared") / F.col("size")).alias("share"))
    )


def scan(docs: DataFrame, scratch: Scratch) -> DataFrame:
    found = matches(scratch.save(text_blocks(docs), "blocks"))
    per_text = found.groupBy("doc_id", "digest").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    per_text = per_text.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "more", "share")
    rows = base_scan(docs)
    rows = rows.join(per_text, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    both = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        score.alias("score"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "op2"))
