"""What an operator remembers in a worker goes when another operator's task begins there."""

from __future__ import annotations

from tidemark.llm import common
from tidemark.llm.pieces import encoder_of, load_vocabulary, public_model


def test_tasks_of_another_operator_start_without_the_units_of_the_pieces():
    vocabulary = load_vocabulary(public_model())
    encoder = encoder_of(vocabulary)
    encoder.encode("some words to remember")
    assert encoder_of(vocabulary) is encoder and len(encoder)
    held = []
    work = common.frugal(lambda batches: (held.append(len(common._remembered)) or b for b in batches))
    assert list(work(iter([1]))) == [1] and held == [0]
    assert encoder_of(vocabulary) is not encoder


def test_one_memory_at_a_time():
    assert common.remembered("a", list) is common.remembered("a", list)
    first = common.remembered("a", list)
    common.remembered("b", dict)
    assert common.remembered("a", list) is not first
    common.forget()
    assert not common._remembered


def test_language_tasks_start_without_other_memories(spark):
    from tidemark.llm import langid

    def left(batches):
        common.remembered("units", lambda: [0])
        yield from batches

    def seen(batches):
        for batch in batches:
            yield batch.filter([bool(common._remembered)] * batch.num_rows)

    one = spark.range(1).selectExpr("id", "'some words' AS text").coalesce(1)
    one.mapInArrow(left, one.schema).count()
    langid.predict(one, langid.Models({"en": b"some words"})).collect()
    assert one.mapInArrow(seen, one.schema).count() == 0
