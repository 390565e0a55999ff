"""The pipeline against plain rules on a small corpus, and the entry's promises."""

import random
import sys

import corpus_pipeline
from millrace.llm import catalog

from test_duplicates import brute as classes
from test_llm_models import toxic_rows


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(11)
    rows, labels = toxic_rows(300)
    toxic = {k for k, t in labels if t}
    item = [f"b{k}" for k in range(30)]
    rows = dict(rows)
    for k in (1, 2, 3):
        rows[k] += " " + " ".join(item[k : k + 15])
    rows[5] += " token = abcdef123456"
    rows[900], rows[901] = rows[7], rows[9] + " end"
    rows[902], rows[903] = None, ""
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, 1, t) for k, t in labels], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")

    left = [(i, t) for i, t in rows.items() if i not in toxic]
    first = {c for _, c in classes(left)}
    want = {i: t for i, t in left if i in first and i not in (1, 2, 3)}
    if 5 in want:
        want[5] = want[5].replace("token = abcdef123456", "[secret]")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i: r.text for i, r in out.items()} == want
    assert all(r.exact and r.n_pieces == len(r.ids or []) for r in out.values())
    assert rng


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "secrets", "pieces"]


def test_oracles(spark):
    import oracle

    folder = "/root/testdata/sf0.001"
    con = oracle.connect(folder)
    for name, sql in catalog.ORACLES.items():
        assert oracle.compare(catalog.QUERIES[name](spark, folder), con, sql) == "", name


def test_nothing_else_imports_the_package():
    for name, module in list(sys.modules.items()):
        if name.startswith("millrace") and not name.startswith("millrace.llm") and getattr(module, "__file__", None):
            assert ".llm" not in open(module.__file__).read(), name
