"""Published copies follow the state of the input."""

import os
import shutil

from conftest import SF_SMALL

from courtview.session import input_state


def test_input_state_changes_with_the_files(spark, tmp_path):
    for name in ("nation", "region"):
        shutil.copy(os.path.join(SF_SMALL, f"{name}.parquet"), tmp_path / f"{name}.parquet")
    before = input_state(spark, str(tmp_path))
    assert [s[0] for s in before] == ["nation.parquet", "region.parquet"] and input_state(spark, str(tmp_path)) == before
    os.utime(tmp_path / "region.parquet", (1, 1))
    assert input_state(spark, str(tmp_path)) != before


def test_rewritten_input_is_read_anew(spark, tmp_path):
    from courtview.plans.staged import raw_videos
    folder = tmp_path / "sf"
    shutil.copytree(SF_SMALL, folder, copy_function=shutil.copyfile)
    os.chmod(folder, 0o755)
    n = raw_videos(spark, str(folder), "content").count()
    fewer = spark.read.parquet(str(folder / "documents.parquet")).limit(n - 3).toPandas()
    fewer.to_parquet(folder / "documents.parquet")
    spark.catalog.refreshByPath(str(folder))
    assert raw_videos(spark, str(folder), "content").count() == n - 3
