"""The five stages, on awkward rows and on a whole table, against what each stage must do."""
import cases
import corpus_pipeline as C
from cases import SF
from kinlink.llm import kk_packing
from kinlink.session import materialize
from test_kk_packing import check
from test_secret_tokens import plain_base
from test_simhash_anchor import expected


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {"documents": [tuple(r) for r in docs.collect()]}
    for name, stage in C.STAGES:
        columns = docs.columns
        docs, _ = materialize(stage(spark, docs, SF), f"test-{name}")
        rows[name] = [tuple(r) for r in docs.collect()]
        assert name == "packing" or docs.columns == columns
    assert set(rows["quality_rules"]) < set(rows["documents"])
    assert sorted(r[0] for r in rows["near_duplicates"]) == sorted({c for *_, c in expected(rows["quality_rules"])})
    assert set(rows["near_duplicates"]) <= set(rows["quality_rules"])
    assert [r[0] for r in sorted(rows["secrets"])] == [r[0] for r in sorted(rows["near_duplicates"])]
    assert not any(plain_base(r[1]) for r in rows["secrets"])
    assert set(rows["mix_domains"]) <= set(rows["secrets"])
    check(rows["mix_domains"], docs.collect())


def test_awkward_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        for name, stage in C.STAGES:
            docs, _ = materialize(stage(spark, docs, SF), f"awkward-{name}")
            docs.count()


def test_run(spark):
    assert C.run(spark, SF).columns[0] == "doc_id" and C.run(spark, SF).count() > 0
    assert [n for n, _ in C.STAGES][-1] == "packing" and kk_packing.CAPACITY == 4096
