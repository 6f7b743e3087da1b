from __future__ import annotations

from pyspark import cloudpickle

from footfall.llm import decontaminate, fingerprints, language, minhash, quality, suffix_dedup, tables, text, token_counts


def test_task_functions_stay_small_once_the_driver_has_hashed(spark):
    text.powers(1 << 22)
    modules = (decontaminate, fingerprints, language, minhash, quality, suffix_dedup, token_counts)
    tasks = [f for m in modules for f in vars(m).values() if callable(f) and getattr(f, "__module__", "") == m.__name__]
    assert len(tasks) > 40
    assert max(len(cloudpickle.dumps(f)) for f in tasks) < 1 << 20


def test_tables_stored_on_the_way_go(spark):
    before = tables.count_stored()

    def make():
        first = tables.stored(spark.range(10), "first")
        return tables.stored(first.where("id > 2"), "second")

    out = tables.stored_alone(spark, make, "third")
    assert tables.count_stored() == before + 1 and out.count() == 7
    tables.drop_stored(spark, before)
    assert tables.count_stored() == before
