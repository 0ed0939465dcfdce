"""What the Python workers of the pipeline hold during a task and between tasks."""

import gc
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from offerlens.llm import bpe, jaccard_join, quality_rules, toxicity
from offerlens.llm import common as c
from offerlens.llm.queries import VOCABULARIES
from tests.llm.helpers import documents


class Shared:
    """Stands for a broadcast."""

    def __init__(self, value):
        self.value = value


def long_batch(mb):
    rng = random.Random(3)
    text = [" ".join("%x" % rng.getrandbits(20) for _ in range(700)) for _ in range(mb * 240)]
    return pa.RecordBatch.from_pydict({"doc_id": list(range(len(text))), "host": ["+a"] * len(text), "text": text})


def score(batch):
    return toxicity._scored(Shared((np.linspace(-1, 1, toxicity.BUCKETS).astype(np.float32), 0.1)), "s")([batch])


def index(batch):
    return jaccard_join._index(Shared(np.zeros(1 << jaccard_join.BUCKET_BITS, np.uint8)))([batch])


def sizes(batch):
    return jaccard_join._measure([batch])


def cut(batch):
    spans = pa.array([[{"start": 0, "stop": 5}]] * len(batch), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
    return quality_rules._cut([batch.append_column("__spans", spans)])


@pytest.mark.parametrize("work,most", [(score, 50), (index, 40), (sizes, 45), (cut, 4)])
def test_a_larger_batch_takes_no_more_memory(work, most):
    batch = long_batch(5)
    c._powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    gc.collect()
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in work(batch))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert rows >= len(batch) and peak < most, peak


def test_scores_come_by_slices_and_do_not_depend_on_them(monkeypatch):
    batch = long_batch(1)
    got = list(score(batch))
    assert max(out.column("text").nbytes for out in got) < 2 * toxicity.SLICE
    monkeypatch.setattr(toxicity, "SLICE", 1 << 30)
    whole, = score(batch)
    assert pa.Table.from_batches(got).drop_columns("s") == pa.Table.from_batches([batch])
    assert np.allclose(pa.Table.from_batches(got).column("s"), whole.column("s"), rtol=1e-12, atol=0)


def test_encoders_go_when_a_worker_does_other_work(spark):
    docs = documents(spark, [(i, f"some words {i}", "en", "a") for i in range(40)]).repartition(4)
    path = f"{VOCABULARIES}/byte_bpe_50k.json"
    assert bpe.round_trip(docs, path).count() == bpe.round_trip(docs, path).filter("n_tokens > 0").count() == 40

    def encoders(batches):
        for _ in batches:
            gc.collect()
            yield pa.RecordBatch.from_pydict({"n": [sum(type(o).__name__ == "Encoder" for o in gc.get_objects())]})

    assert c.map_batches(docs, encoders, "n long").groupBy().sum().first()[0] == 0


def test_long_texts_leave_no_powers_behind():
    n = c.SLICE_BYTES + 100
    up, down = c.powers(n)
    assert len(c._powers[0]) <= c.SLICE_BYTES + 1
    assert up[0] == down[0] == 1 and (up * down == 1).all() and (up[1:] == up[:-1] * c.BASE).all()
