"""The ranking is learnt from all labelled rows, however they are dealt over groups."""

import numpy as np
import pytest

from leadloom import session
from leadloom.llm import quality

from .data import prose


@pytest.mark.parametrize("per_group, limit", [(quality.ROWS_PER_GROUP, session.BROADCAST_ROWS), (100, 0)])
def test_every_labelled_row_counts(spark, monkeypatch, per_group, limit):
    monkeypatch.setattr(session, "BROADCAST_ROWS", limit)
    words = [1 + i % 3 if i % 90 else 40 + i % 7 for i in range(10_000)]
    poor = [i % 90 == 0 for i in range(10_000)]  # a class too small for all groups of 100
    docs = [(i, " ".join(prose(i % 50, n).split()[:n]) + (" ###" * 9 if p else "")) for i, (n, p) in enumerate(zip(words, poor, strict=True))]
    frame = spark.createDataFrame([*docs, *docs[:9], (None, "x " * 5000), (20_000, "x " * 5000)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(not p)) for i, p in enumerate(poor)] + [(None, 1), (20_000, 7)], "doc_id long, quality int")
    model = quality.fit(frame, labels, rows_per_group=per_group)
    counts = np.log1p([len(t.split()) for _, t in docs])
    assert model.mean[0] == pytest.approx(counts.mean(), rel=1e-9)
    assert model.scale[0] == pytest.approx(counts.std(), rel=1e-9)
    scored = frame.where("doc_id < 10000").select("doc_id", quality.quality(model, frame["text"]).alias("s")).collect()
    assert all((r["s"] >= quality.THRESHOLD) == (not poor[r["doc_id"]]) for r in scored)
