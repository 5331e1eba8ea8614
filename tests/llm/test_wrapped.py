"""License notices that are wrapped over lines."""

from __future__ import annotations

import random
import textwrap

from tidemark.llm import licenses
from tidemark.llm.common import Scratch


def prose(rng: random.Random, n: int) -> str:
    return " ".join(f"w{rng.randint(0, 999)}" for _ in range(n))


def test_wrapped_notices(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for _, label, _ in licenses.template_words():
        notice = licenses.TEMPLATES[len(rows) // 4][1]
        wrapped = textwrap.fill(notice, 72 if len(notice) > 72 else 20)
        assert "\n" in wrapped
        commented = "/*\r\n" + "\r\n".join(f" * {line}" for line in wrapped.split("\n")) + "\r\n */"
        long = textwrap.fill(f"{prose(rng, rng.randint(60, 300))} {notice} {prose(rng, 150)}", 60 if len(notice) > 72 else 20)
        apart = f"{prose(rng, 30)}\n\n{wrapped}\n\n{prose(rng, 40)}"
        for text in (wrapped, commented, long, apart):
            want[len(rows)] = label
            rows.append((len(rows), text))
    n = len(rows)
    # Words in another order on unrelated lines are no notice, nor is one with a fifth of its words gone.
    backwards = " ".join(reversed(licenses.TEMPLATES[6][1].split()))
    torn = " ".join(w for i, w in enumerate(licenses.TEMPLATES[6][1].split()) if i % 5)
    rows += [(n, textwrap.fill(backwards, 72)), (n + 1, textwrap.fill(torn, 72)), (n + 2, prose(rng, 9)), (n + 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in licenses.scan(df, Scratch(spark, "wrapped")).collect()}
    missed = {i for i, label in want.items() if label not in got[i].labels.split(",") or got[i].score != 1.0}
    assert not missed
    assert [(got[i].labels, got[i].score) for i in range(n, n + 4)] == [("", 0.0)] * 4
