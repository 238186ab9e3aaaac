import subprocess
import sys
from collections import Counter

import pytest

import corpus_pipeline
from roadframe.llm import dedup, packing, quality
from roadframe.llm.common import stored
from test_dedup import brute_classes


@pytest.fixture(scope="module")
def kept(spark, table):
    """What every stage returns, written and reread."""
    out, docs = [], table("documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        out.append(docs)
    return out


def test_stages_in_order(kept, table):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "mix", "packing"]
    assert all(df.columns == table("documents").columns for df in kept[:-1])


def test_rejected_documents_go(spark, kept, table):
    docs, labels = table("documents"), table("labels")
    scored = quality.score_documents(docs, quality.fit_sample(docs, labels)).collect()
    assert {r.doc_id for r in kept[0].collect()} == {r.doc_id for r in scored if r.quality_score >= 0.5}
    assert 0 < kept[0].count() < docs.count()


def test_one_document_of_each_class_stays(kept):
    classes = brute_classes([(r.doc_id, r.text) for r in kept[0].collect()])
    assert Counter(r.doc_id for r in kept[1].collect()) == Counter({c for _, c in classes})


def test_the_mix_takes_known_documents(kept):
    have = {r.doc_id: r for r in kept[1].collect()}
    times = Counter(r.doc_id for r in kept[2].collect())
    assert set(times) <= set(have) and max(times.values()) == 2
    assert all(have[r.doc_id] == r for r in kept[2].collect())


def test_packed_pieces_are_the_mixs(kept):
    pieces = packing.token_pieces(kept[2]).collect()
    key = lambda rows: Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows)
    assert key(kept[3].collect()) == key(pieces)


def test_empty_and_odd_documents(spark, odd_docs, no_docs, table, tmp_path):
    table("labels").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (no_docs, odd_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "odd")
        docs.collect()


def test_run_is_the_stages(spark, kept):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in rows) == Counter(
        (r.doc_id, r.piece, r.ids_crc32) for r in kept[3].collect())


def test_near_dedup_threshold_is_the_default():
    assert dedup.SIMILARITY == 0.8 and dedup.SHINGLE == 5


def test_library_does_without_the_corpus_operators():
    code = ("import sys\n"
            "class No:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'roadframe.llm'):\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, No())\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert len(q) >= 58 and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q)\n"
            "e.oracle_sql()\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
