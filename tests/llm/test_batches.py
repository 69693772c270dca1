"""What Spark hands to a Python step at once is bounded by bytes, and no result depends on it."""

import pytest

import corpus_pipeline
from tripmart.llm import packing, quality_rules, secret_scan, simhash
from tripmart.llm.common import BATCH_BYTES, BATCH_KEY, importable, slices

from ..conftest import SF_SMALL

STEPS = {
    "quality_rules": (quality_rules, quality_rules.measures),
    "simhash": (simhash, simhash.fingerprints),
    "secret_scan": (secret_scan, secret_scan.mask_documents),
    "packing": (packing, packing.pack_documents),
}


@pytest.fixture
def batch_bytes(spark):
    """Sets the session's bound; the bound of before comes back."""
    before = spark.conf.get(BATCH_KEY, None)

    def put(value):
        spark.conf.unset(BATCH_KEY) if value is None else spark.conf.set(BATCH_KEY, str(value))

    yield put
    put(before)


@pytest.mark.parametrize("name", STEPS)
def test_batches_of_long_rows_are_small(spark, batch_bytes, monkeypatch, name):
    importable(spark)
    module, step = STEPS[name]
    most = 2 * BATCH_BYTES

    def watched(batches):
        for batch in batches:
            if batch.nbytes > most:
                raise ValueError(f"a batch of {batch.nbytes} bytes")
            yield batch

    if module is quality_rules:
        inner = quality_rules._measure
        monkeypatch.setattr(module, "_measure", lambda batches: inner(watched(batches)))
    else:
        monkeypatch.setattr(module, "slices", lambda batches, text: slices(watched(batches), text))
    batch_bytes(None)
    docs = spark.range(0, 2000, 1, 1).selectExpr("id doc_id", "repeat(concat('page ', id, ' of a long text '), 400) text", "'s' source")
    step(docs).write.format("noop").mode("overwrite").save()


def test_a_bound_of_the_session_stays(spark, batch_bytes, edge):
    batch_bytes(12345)
    packing.pack_documents(edge)
    assert spark.conf.get(BATCH_KEY) == "12345"


def test_pipeline_does_not_depend_on_batches(spark, batch_bytes):
    found = []
    for value in (1000, None):
        batch_bytes(value)
        ids = {}
        for piece in sorted(corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "start", "ids").collect()):
            ids.setdefault(piece.doc_id, []).extend(piece.ids)
        found.append(ids)
    assert found[0] and found[0] == found[1]
