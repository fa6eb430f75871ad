import pytest
from oracle import assert_same

from tesserine.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), sf_dir, SQL[name])


def test_names():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_the_training_data_folder(monkeypatch):
    import importlib

    import __spark_entry__ as e

    real = importlib.import_module

    def gone(name, *a):
        if name.startswith(("tesserine.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name.removesuffix(".registry"))
        return real(name, *a)

    monkeypatch.setattr(importlib, "import_module", gone)
    assert set(e.queries()) == set(QUERIES)

    def broken(name, *a):
        raise ModuleNotFoundError("numpy", name="numpy")

    monkeypatch.setattr(importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        e.queries()


def test_entropy_of_odd_texts(spark, tmp_path):
    texts = [(0, ""), (0, "q"), (1, None), (2, "aaaa"), (3, "é"), (4, "a\u0000\u0000b"), (5, "\U0001f600a\r\n"), (6, ""), (7, ""), (7, None), (None, "xy")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert_same(QUERIES["entropy_score"](spark, str(tmp_path)), tmp_path, SQL["entropy_score"])
    none = [str(r["bits"]) for r in QUERIES["entropy_score"](spark, str(tmp_path)).filter("doc_id in (2, 3, 6, 7)").collect()]
    assert none == ["-0.0"] * 4
