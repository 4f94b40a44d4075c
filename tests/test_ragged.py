"""Ragged source: parse cases (shape, numbers, whitespace, files, splits)."""

from __future__ import annotations

import os

from conftest import FIXTURES, HEADER, write_text

from kinetra.sources import ragged


def parse_lines(spark, folder, body, name="f.csv", newline="\n"):
    write_text(folder, name, HEADER + body, newline)
    return ragged.read_ragged(spark, folder, name)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]


def test_frames_take_their_block_in_order(spark, tmp_dir):
    body = "41; Taxi; 812.25; 31.5; " + " ".join(
        f"38.0{i}; 23.7{i}; {40 + i}.5; -0.{i}; 0.0{i}; {i}.2;" for i in range(4)) + "\n"
    b = parse_lines(spark, tmp_dir, body)
    assert rows(b.tracks, "track_id", "vehicle_type", "traveled_d", "avg_speed") == [(41, "Taxi", 812.25, 31.5)]
    assert rows(b.points, "frame_idx", "lat", "lon", "speed", "lon_acc", "lat_acc", "time_sec") == [
        (i, float(f"38.0{i}"), float(f"23.7{i}"), 40.5 + i, -i / 10, i / 100, i + 0.2) for i in range(4)]


def test_shape_rejects_name_their_reason(spark, tmp_dir):
    cut = ["3", "3; Bus", "3; Bus; 9", "3; Bus; 9; 4; 1", "3; Bus; 9; 4; 1; 2; 3; 4; 5", "x; Bus; 9; 4",
           "3; Bus; 9; 4; 1; 2; 3; 4; 5; six"]
    b = parse_lines(spark, tmp_dir, "".join(f"{c};\n" for c in cut))
    got = {r.n_fields: r.reject_reason for r in b.rejects.collect()}
    assert b.tracks.count() == 0 and b.rejects.count() == len(cut)
    assert got == {1: "too_few_fields", 2: "too_few_fields", 3: "too_few_fields", 4: "bad_number",
                   5: "bad_remainder", 9: "bad_remainder", 10: "bad_number"}


def test_drive_file(spark):
    """Own sample: a track without frames, a blank line late in the file, a
    repeated track, a long one, a line without the closing delimiter."""
    b = ragged.read_ragged(spark, FIXTURES, "evening_drive.csv")
    assert sorted(r.track_id for r in b.tracks.collect()) == [11, 12, 12, 15, 18]
    counts = {(r.track_id, r._row_in_split): r["count"]
              for r in b.points.groupBy("track_id", "_row_in_split").count().collect()}
    assert sorted((t, n) for (t, _), n in counts.items()) == [(11, 2), (12, 1), (12, 3), (18, 5)]
    assert b.rejects.count() == 0
    assert {r.source_file for r in b.tracks.collect()} == {"evening_drive.csv"}


def test_separator_of_the_reader_in_a_line_rejects_it_whole(spark, tmp_dir):
    line = "6; Car; 1.0; 2.0; 1; 2; 3; 4; 5; 6; 7; 8;\u0001 9; 10; 11; 12;"
    b = parse_lines(spark, tmp_dir, line + "\n7; Car; 1.0; 2.0;\n")
    assert [r.track_id for r in b.tracks.collect()] == [7] and b.points.count() == 0
    r = b.rejects.first()
    assert (r.line, r.reject_reason) == (line, "control_character")


def test_zero_frames_track_kept(spark, tmp_dir):
    b = parse_lines(spark, tmp_dir, "5; Bus; 1.0; 2.0;\n")
    assert b.tracks.count() == 1 and b.points.count() == 0 and b.rejects.count() == 0


def test_blank_lines_crlf_and_empty_file(spark, tmp_dir):
    b = parse_lines(spark, tmp_dir, "\n1; Car; 1.0; 2.0; 1; 2; 3; 4; 5; 6;\n   \n\n", newline="\r\n")
    assert b.tracks.count() == 1 and b.points.count() == 1 and b.rejects.count() == 0
    write_text(tmp_dir, "empty.csv", "")
    e = ragged.read_ragged(spark, tmp_dir, "empty.csv")
    assert e.tracks.count() == 0 and e.rejects.count() == 0


def test_blank_last_field_rejected(spark, tmp_dir):
    b = parse_lines(spark, tmp_dir, "1; Car; 1.0; 2.0; 1; 2; 3; 4; 5; ;\n")
    assert [r.reject_reason for r in b.rejects.collect()] == ["bad_number"]


def test_number_strictness(spark, tmp_dir):
    body = ("1; Car; 1.0d; 2.0; \n"
            "2; Car; 0x1p3; 2.0; \n"
            "3; Car; ; 2.0; \n"
            "4; Car; 1_0; nan; 1; 2; -nan; inf; 1e3; .5;\n"
            "5; Car; 1; 2; 1; 2; 3; 4; 5; 1.5f;\n")
    b = parse_lines(spark, tmp_dir, body)
    assert sorted(r.first_field for r in b.rejects.collect()) == ["1", "2", "3", "5"]
    t = b.tracks.collect()
    assert [(r.track_id, r.traveled_d) for r in t] == [(4, 10.0)]
    p = b.points.first()
    assert p.speed != p.speed and p.lon_acc == float("inf") and p.lat_acc == 1000.0 and p.time_sec == 0.5


def test_same_track_twice_in_file_first_header_wins_frames_merge(spark, tmp_dir):
    from kinetra.operators.load import first_wins
    from kinetra.schemas import POINT_KEY, TRACK_KEY
    body = ("7; Car; 10.0; 1.0; 1; 1; 1; 1; 1; 1;\n"
            "7; Bus; 20.0; 2.0; 2; 2; 2; 2; 2; 2; 3; 3; 3; 3; 3; 3;\n")
    b = parse_lines(spark, tmp_dir, body)
    t = first_wins(b.tracks, TRACK_KEY).collect()
    assert [(r.vehicle_type, r.traveled_d) for r in t] == [("Car", 10.0)]
    p = rows(first_wins(b.points, POINT_KEY), "frame_idx", "speed")
    assert p == [(0, 1.0), (1, 3.0)]


def test_same_track_in_two_files_both_kept(spark, tmp_dir):
    write_text(tmp_dir, "a.csv", HEADER + "1; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    write_text(tmp_dir, "b.csv", HEADER + "1; Car; 2.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    b = ragged.read_ragged(spark, tmp_dir, "*.csv")
    assert sorted((r.source_file, r.traveled_d) for r in b.tracks.collect()) == [
        ("a.csv", 1.0), ("b.csv", 2.0)]


def test_split_file_header_dropped_once_order_kept(spark, tmp_dir):
    from kinetra.operators.load import first_wins
    from kinetra.schemas import TRACK_KEY
    block = "; ".join(["1.5"] * 6)
    n = 40000
    body = "".join(f"{i % 1000}; Car; {i}.0; 1.0; {block};\n" for i in range(n))
    write_text(tmp_dir, "big.csv", HEADER + body)
    assert os.path.getsize(os.path.join(tmp_dir, "big.csv")) > 1_000_000
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        b = ragged.read_ragged(spark, tmp_dir, "big.csv")
        assert b.parsed.rdd.getNumPartitions() > 1
        assert b.tracks.count() == n and b.rejects.count() == 0
        # first occurrence in file order wins for duplicated track ids
        first = {r.track_id: r.traveled_d for r in first_wins(b.tracks, TRACK_KEY).collect()}
        assert first[999] == 999.0 and first[0] == 0.0 and len(first) == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_longest_row(spark, tmp_dir):
    n = 20000
    blocks = "; ".join(f"37.9; 23.7; {i % 50}.5; 0.1; 0.2; {i * 0.04:.2f}" for i in range(n))
    b = parse_lines(spark, tmp_dir, f"9; Car; 1.0; 1.0; {blocks};\n")
    assert b.points.count() == n
    last = b.points.orderBy("frame_idx", ascending=False).first()
    assert last.frame_idx == n - 1 and last.speed == (n - 1) % 50 + 0.5


def test_undecodable_bytes_rejected(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad_bytes.csv")
    with open(path, "wb") as fh:
        fh.write(HEADER.encode())
        fh.write(b"1; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
        fh.write(b"2; C\xffr; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    b = ragged.read_ragged(spark, tmp_dir, "bad_bytes.csv")
    assert [r.track_id for r in b.tracks.collect()] == [1]
    assert [r.reject_reason for r in b.rejects.collect()] == ["bad_encoding"]


def test_bytes_decide_about_encoding(spark, tmp_dir):
    """A genuine U+FFFD loads, a broken byte rejects its line and no other."""
    good = "1; Vo\u00edture\ufffd; 1; 2; 37.9; 23.7; 5; 0; 0; 0.0\n"
    path = os.path.join(tmp_dir, "bytes.csv")
    with open(path, "wb") as fh:
        fh.write(HEADER.encode() + good.encode() + b"2; Ca\xffr; 1; 2\n" + b"3; Car\xc3; 1; 2\n"
                 + "4; \u8eca\U0001f697; 1; 2\n".encode() + "\u00a0 \u3000\n".encode() + b"5; Car; 1; 2\r\n")
    batch = ragged.read_ragged(spark, tmp_dir, "bytes.csv")
    assert [(r.track_id, r.vehicle_type) for r in batch.tracks.orderBy("track_id").collect()] == [
        (1, "Vo\u00edture\ufffd"), (4, "\u8eca\U0001f697"), (5, "Car")]
    assert batch.points.count() == 1
    assert sorted((r.first_field, r.reject_reason, r.line) for r in batch.rejects.collect()) == [
        ("2", "bad_encoding", "2; Ca\ufffdr; 1; 2"), ("3", "bad_encoding", "3; Car\ufffd; 1; 2")]
