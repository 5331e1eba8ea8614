"""Language identification by compression.

For each language a bounded, documented sample of its labelled documents is put together as
a raw-content zstandard dictionary. A text belongs to the language whose dictionary makes
it smallest. Texts are compressed whole, in pieces of ``PIECE`` bytes: each piece starts
from the dictionary anew, so that the evidence of a long text adds up instead of fading.

The margin between the best and the second-best language, relative to the second, is the
confidence. ``rejected`` marks texts whose margin is narrow, null texts and texts without a
letter (``und``). What is narrow is learned with the dictionaries: of up to ``CHECK_ROWS``
labelled documents that follow the sample in its order, so are not in it, the margins of those
that get their own language are taken; narrow is half their ``LOW`` quantile, and ``NARROW`` at
least. Words of random letters have margins of up to 0.02 from about 200 words on. Where
fewer than ``1 / LOW`` margins are at hand the quantile is not known, and narrow is ``NARROW``.

Only the fit uses labels, and it cuts all texts to ``SAMPLE_CHARS`` characters. The sample takes, per language, the ``SAMPLE_DOCS`` documents that
come first by a hash of id and text, and of each the beginning, until
the dictionary holds ``DICT_BYTES``; at most ``MAX_LANGUAGES`` languages are accepted (more
raise an error), so the broadcast models are bounded. Prediction reads nothing but the text.

Edge cases: no labelled row at all gives ``und`` for every text; repeated rows get equal
predictions; ties of size go to the language that is first by code points; extra columns
are carried along; an empty table gives an empty result.
"""

import re
from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import forget, give_back

SAMPLE_DOCS = 100
SAMPLE_CHARS = 1500
DICT_BYTES = 112 << 10
MAX_LANGUAGES = 400
PIECE = 4096
LEVEL = 5
SHORT = 256
SHORT_LEVEL = 12
NARROW = 0.025
LOW = 0.005
CHECK_ROWS = 2000
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")
NO_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str) -> bytes:
    """Lower case with one blank for every run of other characters than letters."""
    return NO_LETTERS.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


class Models(dict):
    """Dictionary content per language, and the largest margin that is too narrow."""

    narrow = NARROW


def fit(labelled: DataFrame) -> Models:
    """The models of ``(doc_id, text, lang)``."""
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    languages = [r.lang for r in usable.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    last = SAMPLE_DOCS + CHECK_ROWS // max(1, len(languages))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "doc_id")
    sample = (
        usable.select("lang", "doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= last)
    )
    pieces: dict[str, list[bytes]] = {}
    others = []
    for row in sample.orderBy("lang", "n").toLocalIterator():
        if row.n <= SAMPLE_DOCS:
            pieces.setdefault(row.lang, []).append(folded(row.text))
        else:
            others.append((row.lang, row.text))
    models = Models({lang: b"\n".join(dict.fromkeys(texts))[-DICT_BYTES:] for lang, texts in sorted(pieces.items())})
    models.narrow = narrow_margin(labelled.sparkSession, others, models)
    return models


def narrow_margin(spark: SparkSession, others: list[tuple[str, str]], models: Models) -> float:
    """Half the ``LOW`` quantile of the margins of the ``(lang, text)`` that get their language."""
    if not others:
        return NARROW
    found = predict(spark.createDataFrame(others, "lang string, text string"), models)
    right = found.filter("__language.lang_pred = lang").select("__language.score").collect()
    margins = sorted(r.score for r in right)
    return max(NARROW, margins[int(LOW * len(margins))] / 2) if LOW * len(margins) >= 1 else NARROW


def coder(content: bytes, level: int) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        level=level, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False
    )


class Classifier:
    def __init__(self, models: dict[str, bytes]):
        self.languages = list(models)
        self.narrow = getattr(models, "narrow", NARROW)
        self.coders = [coder(content, LEVEL) for content in models.values()]
        self.short_coders = [coder(content, SHORT_LEVEL) for content in models.values()]

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, margin in [0, 1] and whether it is rejected."""
        if not self.coders or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        data = folded(text)
        coders = self.coders if len(data) > SHORT else self.short_coders
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in coders]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.languages[0], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / second
        return self.languages[best], margin, margin <= self.narrow


def predict(docs: DataFrame, models: dict[str, bytes], text: str = "text") -> DataFrame:
    """Add ``__language``, a struct of lang_pred, score and rejected, to ``docs``."""
    if "__language" in {c.lower() for c in docs.columns}:
        raise ValueError("the documents have a column __language; put theirs into a struct")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(models)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget()
        model = Classifier(shared.value)
        for texts in batches:
            yield pd.DataFrame([model(t) for t in texts], columns=["lang_pred", "score", "rejected"])
        del model
        give_back()

    return docs.withColumn("__language", classify(F.col(text)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = fit(docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    found = predict(docs.select("doc_id", "text"), models)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "__language.*")
