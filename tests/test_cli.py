"""The build command end to end in its own process, as a user runs it."""

import os
import subprocess
import sys

import domain_fixture

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_build_command(tmp_path):
    p = domain_fixture.write(str(tmp_path / "raw"))
    out, csv_out = str(tmp_path / "wh"), str(tmp_path / "csv")
    cmd = [sys.executable, "-m", "skyledger.build", "--sessions", p["sessions"], "--rates", p["rates"],
           "--magnitudes", p["magnitudes"], "--weather", p["weather"], "--weather-codes", p["weather_codes"],
           "--showers", p["showers"], "--locations", p["locations"], "--addresses", p["addresses"],
           "--out", out, "--csv-out", csv_out]
    env = {**os.environ, "PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false "
                                                                  "pyspark-shell"}
    r = subprocess.run(cmd, capture_output=True, text=True, timeout=900, env=env, cwd=str(tmp_path))
    assert r.returncode == 0, r.stderr[-3000:]
    assert "== q1_meteors_in_month" in r.stdout and "QUA" in r.stdout
    for name in ("dim_local", "dim_date", "dim_time", "dim_user", "dim_shower", "dim_junk", "dim_weather_code",
                 "fact_observations", "fact_magnitude", "fact_weather"):
        assert os.path.isdir(os.path.join(out, name)) and os.path.isdir(os.path.join(csv_out, name))
    assert os.path.isdir(os.path.join(out, "fact_observations", "year=2022"))
