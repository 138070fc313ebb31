"""The command-line entry points, run in-process on the test session."""

from __future__ import annotations

from meterlake.__main__ import main
from meterlake.plans import registry
from meterlake.sources.fixtures import meter_readings
from meterlake.sinks.publish import write_envelope_files
from tests.conftest import SF_SMALL


def test_stream_models_and_load_commands(spark, tmp_dir, capsys):
    log = write_envelope_files(registry.envelope_log(meter_readings(spark, SF_SMALL, "dense")), f"{tmp_dir}/log")
    assert main(["stream", "--log-dir", log, "--out", f"{tmp_dir}/layers"]) == 0
    out = capsys.readouterr().out
    assert "bronze" in out and "window_start" in out

    source = f"{tmp_dir}/source"
    meter_readings(spark, SF_SMALL).write.parquet(source)
    # the fixture source has NULL meter ids on purpose: the gate fails
    assert main(["models", "--source", source, "--out", f"{tmp_dir}/marts"]) == 1
    out = capsys.readouterr().out
    assert "not published" in out and "not_null" in out
    for mode in ("full", "incremental"):  # nothing was published before; the second run extends the fact
        assert main(["models", "--source", source, "--out", f"{tmp_dir}/marts", "--no-gate"]) == 0
        assert f"fact run: {mode}" in capsys.readouterr().out
    delivery = ["models", "--source", source, "--out", f"{tmp_dir}/marts", "--no-gate", "--delivery", "d1", "--late", "merge"]
    assert main(delivery) == 0 and "fact run: merged" in capsys.readouterr().out
    assert main(delivery) == 0 and "published before" in capsys.readouterr().out
    assert main(["compact", "--out", f"{tmp_dir}/marts"]) == 0

    assert main(["stream", "--log-dir", log, "--out", f"{tmp_dir}/one", "--mode", "one_parse"]) == 0
    assert "window_start" in capsys.readouterr().out
    assert main(["compact", "--out", f"{tmp_dir}/one"]) == 0 and main(["compact", "--out", f"{tmp_dir}/none"]) == 1

    silver = f"{tmp_dir}/layers/silver"
    assert main(["load", "--silver", silver, "--table", "cli_load_test", "--location", f"{tmp_dir}/wh"]) == 0
    assert "loaded 936 rows" in capsys.readouterr().out
