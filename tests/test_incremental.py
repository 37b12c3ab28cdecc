import json
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostpulse.config import FEATURES, RAW_HEADER
from hostpulse.operators.cleaning import clean
from hostpulse.operators.known_keys import KEYS_PER_BUCKET, bucket_bits, filters, possibly_known
from hostpulse.operators.windows import build_features
from hostpulse.plans import incremental
from hostpulse.sources.csv_logs import FILE_ORDER, read_log_folder


def line(day, minute, host, size, status="200", url="/a"):
    return ",".join([host, f"{day:02d}/Jan/2024 10:{minute:02d}:00", "GET", url, "HTTP/1.1", status, str(size), "-", "Mozilla"])


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(RAW_HEADER), *lines]) + "\n")


def expected(spark, folders):
    log = read_log_folder(spark, [str(f) for f in folders])
    cleaned = clean(log, FILE_ORDER)
    return cleaned, build_features(cleaned, 3600)


def same(ours, full):
    assert set(ours.columns) == set(full.columns)
    key = sorted(full.columns)
    assert Counter(map(tuple, ours.select(key).collect())) == Counter(map(tuple, full.select(key).collect()))


def check(spark, state, folders):
    cleaned, features = expected(spark, folders)
    same(incremental.cleaned(spark, state), cleaned)
    same(incremental.features(spark, state).select("host", "window_start", *FEATURES), features)


def test_new_files_only_give_what_a_full_run_gives(spark, tmp_path):
    """Each run gets a folder with its new files only, so older files cannot have been read again."""
    out = str(tmp_path / "state")
    one, two, three = (tmp_path / n for n in ("one", "two", "three"))
    write(one, "m.csv", [line(d, m, f"h{m % 3}", m) for d in (1, 2, 3) for m in range(20)] + [line(1, 0, "", 5), line(1, 5, "h2", 77)])
    first = incremental.update(spark, str(one), out, 3600)
    check(spark, out, [one])
    # Day 2 gets later copies and new rows, day 3 copies from a file that comes first, day 4 is new.
    write(two, "z.csv", [line(2, m, f"h{m % 3}", 1000 + m) for m in range(10)] + [line(2, 50, "new", 1)])
    write(two, "a.csv", [line(3, m, f"h{m % 3}", 2000 + m) for m in range(5)] + [line(4, 1, "h0", 3)])
    second = incremental.update(spark, str(two), out, 3600)
    check(spark, out, [one, two])
    assert second.days["2024-01-01"] == first.days["2024-01-01"]
    assert second.days["2024-01-02"]["parts"][0] == first.days["2024-01-02"]["parts"][0] and len(second.days["2024-01-02"]["parts"]) == 2
    assert len(second.days["2024-01-03"]["parts"]) == 1 and second.days["2024-01-03"] != first.days["2024-01-03"]
    # Copies only: no day changes. A file without a header is remembered, not read again.
    write(three, "zz.csv", [line(1, m, f"h{m % 3}", 9) for m in range(20)])
    (three / "bad.csv").write_text("no header\n")
    third = incremental.update(spark, str(three), out, 3600)
    check(spark, out, [one, two, three])
    assert third.days == second.days and third.version == 3
    assert incremental.update(spark, str(three), out, 3600).version == 3


def test_many_parts_are_written_as_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "MOST_PARTS", 2)
    out, raw = str(tmp_path / "state"), tmp_path / "raw"
    for i in range(4):
        write(raw, f"f{i}.csv", [line(1, 10 * i + m, f"h{i}", m, url=url) for m in range(3) for url in ("/a", "")])
        state = incremental.update(spark, str(raw), out, 3600)
    assert [len(d["parts"]) for d in state.days.values()] == [2]
    check(spark, out, [raw])


def test_a_failed_run_leaves_the_last_state(spark, tmp_path, monkeypatch):
    out, raw = str(tmp_path / "state"), tmp_path / "raw"
    write(raw, "a.csv", [line(1, m, "h", m) for m in range(5)])
    incremental.update(spark, str(raw), out, 3600)
    before = incremental.cleaned(spark, out).count()
    write(raw, "b.csv", [line(1, 30 + m, "h", m) for m in range(5)])

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "_commit", stop)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.update(spark, str(raw), out, 3600)
    assert incremental.cleaned(spark, out).count() == before
    stale = incremental.load_state(spark, out)
    incremental.update(spark, str(raw), out, 3600)
    check(spark, out, [raw])
    # A run that started from the earlier state cannot commit its version again.
    with pytest.raises(Exception, match="exist"):
        incremental._commit(spark, out, incremental.State(stale.version + 1))
    names = sorted(p.name for p in Path(out, "manifests").glob("*.json"))
    assert names == ["00000001.json", "00000002.json"] and json.loads(Path(out, "manifests", names[-1]).read_text())["version"] == 2


def test_changed_files_and_odd_windows_are_errors(spark, tmp_path):
    out, raw = str(tmp_path / "state"), tmp_path / "raw"
    write(raw, "a.csv", [line(1, 1, "h", 1)])
    incremental.update(spark, str(raw), out, 3600)
    write(raw, "a.csv", [line(1, 1, "h", 1), line(1, 2, "h", 1)])
    with pytest.raises(ValueError, match="changed"):
        incremental.update(spark, str(raw), out, 3600)
    with pytest.raises(ValueError, match="divide"):
        incremental.update(spark, str(raw), out, 7)
    with pytest.raises(ValueError, match="windows of 3600"):
        incremental.update(spark, str(raw), out, 60)


@pytest.mark.parametrize("split", [1, 3])
def test_filters_miss_no_known_key(spark, split):
    bits = 2
    keys = spark.range(20000).select(F.xxhash64("id").alias("key"))
    parts = keys.select(F.lit("p").alias("part"), F.lit(bits).alias("bits"), "key")
    made = filters(parts)
    assert made.count() == 4
    others = spark.range(20000, 60000).select(F.xxhash64("id").alias("key"))
    asked = keys.union(others).select(F.lit("p").alias("part"), F.lit(bits).alias("bits"), F.lit(split).alias("split"), "key")
    found = {r.key for r in possibly_known(asked, made).collect()}
    known = {r.key for r in keys.collect()}
    assert known <= found and len(found - known) < 0.03 * 40000


def test_bucket_bits():
    assert [bucket_bits(n) for n in (0, 1, KEYS_PER_BUCKET, KEYS_PER_BUCKET + 1, 2 * KEYS_PER_BUCKET + 1, 10**9)] == [0, 0, 0, 1, 2, 15]
    assert np.ceil(10**9 / 2**15) <= KEYS_PER_BUCKET


def test_keys_carry_numbers_and_many_known_keys_are_shuffled(spark, tmp_path, monkeypatch):
    """Rows on their way to the filters name their part briefly; above the limit nothing known is broadcast, with the same rows."""
    monkeypatch.setattr(incremental, "BROADCAST_KEYS", 0)
    carried, ask, build = [], incremental.possibly_known, incremental.filters

    def asked(keys, made):
        carried.extend(r.part for r in keys.select("part").distinct().collect())
        return ask(keys, made)

    def built(keys):
        carried.extend(r.part for r in keys.select("part").distinct().collect())
        return build(keys)

    monkeypatch.setattr(incremental, "possibly_known", asked)
    monkeypatch.setattr(incremental, "filters", built)
    out, one, two = str(tmp_path / "state"), tmp_path / "one", tmp_path / "two"
    write(one, "m.csv", [line(d, m, f"h{m % 3}", m) for d in (1, 2) for m in range(6)])
    write(two, "a.csv", [line(2, m, f"h{m % 3}", 50 + m) for m in range(4)] + [line(1, 30, "new", 1)])
    incremental.update(spark, str(one), out, 3600)
    incremental.update(spark, str(two), out, 3600)
    assert carried and max(map(len, carried)) <= 10
    check(spark, out, [one, two])
