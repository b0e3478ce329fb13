"""Sources and sinks: durations, backups, transcripts, canonical dictionaries, keyed batches."""

import wave
from datetime import datetime

import numpy as np

from tidemark.sources import documents as src
from tidemark.streaming import windows


def test_durations(spark, tmp_path):
    for name, seconds, channels in (("a", 1.5, 1), ("b", 0.25, 2)):
        with wave.open(f"{tmp_path}/{name}.wav", "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(2)
            w.setframerate(8000)
            w.writeframes(np.zeros(int(seconds * 8000) * channels, "<i2").tobytes())
    got = {r.path[-5:]: r.duration_ms for r in src.probe_durations(spark, str(tmp_path)).collect()}
    assert got == {"a.wav": 1500, "b.wav": 250}


def test_levels_of_a_range(spark, tmp_path):
    x = (np.sin(np.arange(8000 * 200) / 9) * np.linspace(0, 20_000, 8000 * 200)).astype("<i2")
    both = np.stack([x, -x // 2], 1)
    for name, sound, channels in (("one", x, 1), ("two", both, 2)):
        with wave.open(f"{tmp_path}/{name}.wav", "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(2)
            w.setframerate(8000)
            w.writeframes(sound.tobytes())
    for start, end in ((0, None), (1234, 150_100), (199_900, None), (500_000, None)):
        got = {(r.path[-7:-4], r.frame_no): r.rms for r in src.read_wav_levels(spark, str(tmp_path), start_ms=start, end_ms=end, part=7).collect()}
        want = {}
        for name, sound in (("one", x / 32768), ("two", both.mean(1) / 32768)):
            part = sound[start * 8 : end and end * 8]
            part = part[: len(part) // 2000 * 2000].reshape(-1, 2000)
            want |= {(name, k): float(np.sqrt((f * f).mean())) for k, f in enumerate(part)}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_backup_is_made_once(spark, tmp_path):
    at = f"{tmp_path}/t"
    for n in (3, 2, 1):
        src.backup_once(spark.range(n), at)
    assert spark.read.parquet(at).count() == 1 and spark.read.parquet(f"{at}.bak").count() == 3


def test_transcripts_of_complete_items(spark, tmp_path):
    lines = spark.createDataFrame([(1, i, f"line {i}") for i in range(30)] + [(2, 0, "x")], "media long, turn long, line string")
    to = src.export_transcripts(lines, spark.createDataFrame([(1,)], "media long"), f"{tmp_path}/e", datetime(2024, 5, 6, 7, 8, 9))
    assert to.endswith("0506-070809")
    assert [r.value for r in spark.read.text(f"{to}/media=1").collect()] == [f"line {i}" for i in range(30)]
    assert not src.exists(spark, f"{to}/media=2")


def test_drift(spark):
    good = src.canonical({"b": 1, "a": ["ё"]})
    rows = spark.createDataFrame([("x", good), ("y", '{"b":1}')], "path string, value string")
    assert [r.path for r in src.drifted(rows).collect()] == ["y"]


def test_keyed_batches(spark, tmp_path):
    schema = "id long, at long, value string"
    rows = [[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c")], [(1, 0, "late"), (3, 5, "d"), (2, 1, "again")]]
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        windows.keyed_upsert(stream, f"{tmp_path}/t", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    read = lambda: sorted(map(tuple, windows.latest(spark, f"{tmp_path}/t", schema, key="id", order="at").collect()))
    want = [(1, 2, "c"), (2, 1, "again"), (3, 5, "d")]
    assert read() == want
    windows.compact(spark, f"{tmp_path}/t", schema, key="id", order="at", before=1)
    assert read() == want and not src.exists(spark, f"{tmp_path}/t/epoch=0")


def test_optional_modules_alone_may_be_missing(monkeypatch, tmp_path):
    import sys

    import pytest

    import __spark_entry__ as entry

    assert entry.optional("tidemark.llm.no_such_module") is None and entry.optional("corpus_pipeline.nothing") is None
    with pytest.raises(ModuleNotFoundError):
        entry.optional("no_such_library_at_all")
    (tmp_path / "broken_part.py").write_text("import another_missing_library\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        entry.optional("broken_part")
    sys.modules.pop("broken_part", None)


def test_command_line(spark, tmp_path, capsys):
    import pytest

    from tidemark import __main__ as cli

    assert cli.main(["list"]) == 0 and "merge_short" in capsys.readouterr().out
    assert cli.main(["run", "speaker_counts", "--input", "/root/testdata/sf0.001/", "--output", f"{tmp_path}/o"]) == 0
    assert spark.read.parquet(f"{tmp_path}/o").count() > 0
    for wrong in (["run", "speaker_counts", "--input"], ["run", "no_such", "--input", "x"], []):
        with pytest.raises(SystemExit) as e:
            cli.main(wrong)
        assert e.value.code == 2
