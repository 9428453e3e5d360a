import corpus_pipeline
import pytest
from canopy.llm import minhash, pii, quality
from canopy.llm.queries import ORACLE_SQL, QUERIES

from .conftest import SF
from .test_minhash import brute
from .test_packing import check


def test_names():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "pii", "packing"]
    assert QUERIES["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_run_against_plain_stages(spark):
    """Each stage's decision taken in Python, the pieces checked against the tokenizer."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    refs = quality.references(df)
    rows = [r for r in df.collect() if quality.judge_text((r["text"] or "").encode(), refs.get(r["lang"], refs[""]))[-1]]
    least = {}
    for r in rows:
        least[r["text"]] = min(r["doc_id"], least.get(r["text"], r["doc_id"]))
    docs = sorted((i, t) for t, i in least.items())
    docs = [d for d, (_, c) in zip(docs, brute(docs, minhash.SHINGLE_WORDS)) if c == d[0]]
    kept = spark.createDataFrame(docs, "doc_id long, text string")
    model = pii.train(kept)
    clean = [(i, pii.redacted(t, pii.all_spans(t, model))) for i, t in docs]
    check([r.asDict() for r in corpus_pipeline.run(spark, SF).collect()], clean)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, odd, none, name, stage):
    for docs in (odd, none):
        got = stage(spark, docs, SF)
        if name != "packing":
            assert got.columns == docs.columns
        rows = got.count()
        assert rows <= docs.count() or name == "packing"
        assert rows == 0 or docs is odd


def test_redaction_takes_effect(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd now", "en", "s", 15), (2, None, "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.personal_data(spark, docs, SF).collect()}
    assert got == {1: ("mail [EMAIL] now", 16), 2: (None, 0)}


def test_columns_of_any_type_pass_the_stages(spark):
    text = " ".join(f"word{k} of the {k}" for k in range(40))
    rows = [(k, text + f" {k}", "en", {"a": k}) for k in range(3)] + [(9, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, tags map<string,int>")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs, SF).count() <= 4


def test_stages_leave_nothing_behind_that_is_not_needed(spark):
    """After a run: the redacted documents and the ids of the last stage."""
    import glob
    from canopy.session import checkpoint_dir
    top = checkpoint_dir(spark).removeprefix("file:") + "/canopy-scratch/*"
    before = set(glob.glob(top))
    pieces = corpus_pipeline.run(spark, SF)
    left = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in set(glob.glob(top)) - before}
    assert left == {"pipeline-pii", "packing"} and pieces.count() > 0
