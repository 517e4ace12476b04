"""Session helpers: checkpoint folder, tables, active-session settings."""

from lexiscope import session as S


def test_checkpoint_dir_and_scratch(spark):
    d = S.ensure_checkpoint_dir(spark)
    assert d and S.scratch_path(spark, "x").startswith(d.rstrip("/") + "/tables/x-")
    df = spark.range(10)
    assert S.cut_lineage(df).count() == 10


def test_tables_are_read_as_they_lie(spark, sf):
    plan = S.read_table(spark, sf, "documents")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Repartition" not in plan


def test_build_session_keeps_active_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    s = S.build_session("local[2]", shuffle_partitions=99)
    assert s is spark and s.conf.get("spark.sql.shuffle.partitions") == before


def test_submitted_settings_win(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    import pyspark
    root = Path(__file__).resolve().parents[1]
    job = tmp_path / "job.py"
    job.write_text(f"""import sys
sys.path.insert(0, {str(root)!r})
from lexiscope.session import build_session
s = build_session("local[1]")
print("SHUFFLE", s.conf.get("spark.sql.shuffle.partitions"), s.sparkContext.getConf().get("spark.driver.memory"))
""")
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY")} | {"PYSPARK_PYTHON": sys.executable}
    out = subprocess.run([str(Path(pyspark.__file__).parent / "bin/spark-submit"), "--conf", "spark.ui.enabled=false",
                          "--conf", "spark.sql.shuffle.partitions=777", "--driver-memory", "1g", str(job)],
                         capture_output=True, text=True, timeout=180, env=env).stdout
    assert "SHUFFLE 777 1g" in out
