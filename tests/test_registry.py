"""Registry versions under concurrent writers."""

from concurrent.futures import ThreadPoolExecutor

from sparkprep.operators import registry_tables as R


def test_concurrent_writers_get_their_own_versions(spark, tmp_dir):
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda i: R.register_model(spark, tmp_dir, "lead/model", f"/m/{i}", f"run{i}"), range(6)))
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert R.latest_model_path(spark, tmp_dir, "lead/model") == (6, f"/m/{got.index(6)}")
    assert R.register_model(spark, tmp_dir, "other", "/m", "r") == 1


def test_a_version_is_claimed_once_and_gaps_are_passed(spark, tmp_dir):
    path = f"{tmp_dir}/a/b/1"
    assert R.claim(spark, path) and not R.claim(spark, path) and not R.claim(spark, f"file://{path}")
    assert R.register_model(spark, tmp_dir, "m", "/m", "r") == 1
    import hashlib

    assert R.claim(spark, f"{tmp_dir}/registry_versions/{hashlib.sha256(b'm').hexdigest()}/2")  # a writer that died
    assert R.register_model(spark, tmp_dir, "m", "/m2", "r") == 3
    assert R.latest_model_path(spark, tmp_dir, "m") == (3, "/m2")
