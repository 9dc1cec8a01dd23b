import pyarrow as pa

from sentilake.llm import common, token_files
from tests.llm.test_token_files import PATH


def test_words_that_stand_once_are_not_kept():
    enc = token_files.SegmentEncoder(PATH)
    enc.encode(["a once twice twice", "b other"])
    assert set(enc.later) == {"twice"}


def test_a_full_cache_keeps_the_words_at_hand(monkeypatch):
    monkeypatch.setattr(token_files, "MAX_CACHED", 2)
    enc = token_files.SegmentEncoder(PATH)
    enc.encode(["x a a b b c c"])
    enc.encode(["x c d d"])
    assert set(enc.later) == {"c", "d"}


def test_checksums_let_go_of_the_encoder(monkeypatch):
    done = []
    monkeypatch.setattr(common, "_HELD", {"tokens": lambda: done.append("tokens")})
    assert list(token_files._checksums(iter([]))) == [] and done == ["tokens"]


def test_steps_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(token_files, "BYTES_PER_STEP", 10)
    assert list(token_files._steps(pa.array(["x" * 4, None, "x" * 6, "x" * 30, "", "x"]))) == [(0, 3), (3, 4), (4, 6)]
    assert list(token_files._steps(pa.array([], pa.string()))) == []


def test_batch_size_is_set_back(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with common.small_batches(spark, "1m"):
        assert spark.conf.get(name) != before
    assert spark.conf.get(name) == before


def test_near_duplicates_let_go_of_other_tables():
    import inspect

    from sentilake.llm import near_duplicates
    for step in (near_duplicates.document_frequencies, near_duplicates.signatures):
        assert 'hold("near-duplicates"' in inspect.getsource(step)


def test_decontamination_lets_go_of_other_tables_and_is_let_go_of(monkeypatch):
    """Its automaton stayed in a worker for good."""
    import inspect

    from sentilake.llm import decontamination
    assert 'hold("decontamination", _FINDERS.clear)' in inspect.getsource(decontamination.finder_udf)
    monkeypatch.setattr(common, "_HELD", {})
    decontamination._FINDERS["key"] = object()
    common.hold("decontamination", decontamination._FINDERS.clear)
    common.hold("tokens", lambda: None)
    assert not decontamination._FINDERS


def test_python_steps_of_the_pipeline_get_small_batches(spark, monkeypatch):
    import corpus_pipeline
    from sentilake.llm import near_duplicates
    from tests.llm.helpers import empty_documents
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(name)
    try:
        corpus_pipeline.bound_batches(spark)
        assert spark.conf.get(name) == corpus_pipeline.ARROW_BATCH != before
    finally:
        spark.conf.set(name, before)
    old = near_duplicates.signatures
    monkeypatch.setattr(near_duplicates, "signatures", lambda *a: seen.append(spark.conf.get(name)) or old(*a))
    near_duplicates.near_duplicate_classes(empty_documents(spark))
    assert seen == ["4m"] and spark.conf.get(name) == before
