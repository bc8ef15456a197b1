"""Every query key compiles under whole-stage code generation: with the
interpreted fallback disabled, a compilation failure raises instead of
silently running slower."""
import os

import pytest

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_all_keys_compile_without_fallback(spark):
    from panelspark.queries import QUERIES
    key = "spark.sql.codegen.fallback"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        failed = []
        for name, fn in QUERIES.items():
            try:
                fn(spark, SMOKE).write.format("noop").mode("overwrite").save()
            except Exception as e:  # noqa: BLE001
                failed.append((name, type(e).__name__))
        assert failed == []
    finally:
        spark.conf.set(key, before)
