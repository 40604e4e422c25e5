import io
import lzma
import os
import tarfile
import tracemalloc

import pytest
import wire

from tickloom.fixtures import capture_files
from tickloom.operators import decode
from tickloom.schema import MESSAGE_COLUMNS
from tickloom.sources import capture, listing

KINDS = "NMXTCGHJKZ"


def sample(count):
    return [wire.record(kind=KINDS[i % 10], cap_s=2**31 + i if i % 7 == 0 else 1_700_000_000 + i, cap_ns=i,
                        seq=-i if i % 3 == 0 else i, token=10_000 + i, side="BS"[i % 2], price=-i if i % 5 == 0 else i,
                        qty=i, id_a=2.0**53 - i, id_b=float(i), stream=-1 if i % 11 == 0 else i % 16)
            for i in range(count)]


def write(path, records, torn=b""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(b"".join(records) + torn)


def decoded(spark, files, **options):
    lanes = capture.read_capture(spark, files, **options)
    return [wire.shown(row) for row in decode.decode(lanes).orderBy("record_no").select(*MESSAGE_COLUMNS).collect()]


@pytest.mark.parametrize("torn", [0, 1, 71])
@pytest.mark.parametrize("split_bytes", [72, 1000, 1 << 20])
def test_decoding_does_not_depend_on_splits(spark, folder, torn, split_bytes):
    records = sample(97)
    write(f"{folder}/a.cap", records, b"\x01" * torn)
    files = listing.list_files(spark, folder)
    got = decoded(spark, files, split_bytes=split_bytes, batch_records=13)
    assert got == [wire.message(raw) for raw in records]
    assert capture.trailing_bytes(files).first().trailing_bytes == torn


def test_record_numbers_and_stem(spark, folder):
    write(f"{folder}/x_1.cap", sample(50))
    lanes = capture.read_capture(spark, listing.list_files(spark, folder), ["archive_stem", "record_no", "seq_no"],
                                 split_bytes=720)
    rows = lanes.orderBy("record_no").collect()
    assert [row.record_no for row in rows] == list(range(50))
    assert {row.archive_stem for row in rows} == {"x_1"}
    assert lanes.rdd.getNumPartitions() == 5


def test_splits_grow_instead_of_dropping_records():
    splits = capture.plan_splits([("/a.cap", 72 * 1000 + 5), ("/b.cap.tar.xz", 9)], 72, 10)
    assert [s.path for s in splits][0] == "/b.cap.tar.xz"
    plain = [s for s in splits if s.path == "/a.cap"]
    assert len(plain) <= 11 and sum(s.count for s in plain) == 1000


def test_archive_is_read_like_the_capture_inside(spark, folder):
    records = sample(60)
    os.makedirs(folder)
    wire.archive(f"{folder}/e_1.cap.tar.xz", e__cap=b"".join(records) + b"abc", notes__txt=b"hello")
    assert decoded(spark, listing.list_files(spark, folder), batch_records=7) == [wire.message(r) for r in records]


@pytest.mark.parametrize("block_bytes, split_bytes", [(100, 1), (1000, 1), (1000, 2500), (333, 700), (5000, 1 << 30)])
def test_archive_of_many_blocks_is_split(spark, folder, block_bytes, split_bytes):
    records = sample(97)
    os.makedirs(folder)
    wire.blocked_archive(f"{folder}/e_1.cap.tar.xz", block_bytes, a__txt=b"n" * 700, e__cap=b"".join(records) + b"abc")
    files = listing.list_files(spark, folder)
    lanes = capture.read_capture(spark, files, probe_bytes=0, split_bytes=split_bytes)
    assert (lanes.rdd.getNumPartitions() > 1) == (split_bytes < 5000)
    assert [r.record_no for r in lanes.orderBy("record_no").collect()] == list(range(97))
    assert decoded(spark, files, probe_bytes=0, split_bytes=split_bytes, batch_records=5) == [wire.message(r) for r in records]


def test_split_archives_are_checked_too(spark, folder):
    os.makedirs(folder)
    data = b"".join(sample(30))
    wire.blocked_archive(f"{folder}/two.cap.tar.xz", 500, a__cap=data, b__cap=data)
    files = listing.list_files(spark, folder)
    with pytest.raises(Exception, match="expected one capture"):
        capture.read_capture(spark, files, probe_bytes=0)
    assert capture.read_capture(spark, files, probe_bytes=0, split_bytes=1, members="first").count() == 30
    wire.blocked_archive(f"{folder}/two.cap.tar.xz", 500, a__txt=data)
    with pytest.raises(Exception, match="no capture inside"):
        capture.read_capture(spark, files, probe_bytes=0)
    marked = capture.read_capture(spark, files, probe_bytes=0, unreadable="mark")
    assert [r.defect for r in decode.classify(marked).collect()] == ["unreadable"]


def test_archive_of_one_block_is_read_whole(spark, folder):
    os.makedirs(folder)
    wire.archive(f"{folder}/e.cap.tar.xz", e__cap=b"".join(sample(40)))
    lanes = capture.read_capture(spark, listing.list_files(spark, folder), probe_bytes=0, split_bytes=1)
    assert lanes.rdd.getNumPartitions() == 1 and lanes.count() == 40


def test_archive_must_hold_one_capture(spark, folder):
    os.makedirs(folder)
    data = b"".join(sample(3))
    wire.archive(f"{folder}/two.cap.tar.xz", a__cap=data, b__cap=data)
    files = listing.list_files(spark, folder)
    with pytest.raises(Exception, match="expected one capture"):
        capture.read_capture(spark, files).count()
    assert capture.read_capture(spark, files, members="first").count() == 3


def test_archive_without_a_capture_fails_or_is_marked(spark, folder):
    os.makedirs(folder)
    wire.archive(f"{folder}/none.cap.tar.xz", a__txt=b"x")
    files = listing.list_files(spark, folder)
    with pytest.raises(Exception, match="no capture inside"):
        capture.read_capture(spark, files).count()
    marked = decode.classify(capture.read_capture(spark, files, unreadable="mark")).collect()
    assert [row.defect for row in marked] == ["unreadable"]


def test_damaged_archive_is_marked(spark, folder):
    os.makedirs(folder)
    wire.archive(f"{folder}/d.cap.tar.xz", a__cap=os.urandom(72 * 4000))
    with open(f"{folder}/d.cap.tar.xz", "r+b") as handle:
        handle.truncate(os.path.getsize(f"{folder}/d.cap.tar.xz") // 2)
    lanes = capture.read_capture(spark, listing.list_files(spark, folder), unreadable="mark")
    assert decode.classify(lanes).filter("defect = 'unreadable'").count() == 1


def test_empty_folder_and_empty_capture(spark, folder):
    write(f"{folder}/e.cap", [], b"\x00" * 10)
    assert capture.read_capture(spark, listing.list_files(spark, folder)).count() == 0
    assert capture.read_capture(spark, listing.list_files(spark, folder, "*.none")).count() == 0


def test_unwanted_types_stay_in_the_scan(spark, folder):
    write(f"{folder}/f.cap", sample(100))
    files = listing.list_files(spark, folder)
    wanted = capture.read_capture(spark, files, ["record_no", "msg_type_code"], types="NZ", batch_records=7)
    assert sorted(r.record_no for r in wanted.collect()) == [i for i in range(100) if KINDS[i % 10] in "NZ"]


def test_one_read_serves_several_queries(spark, folder):
    write(f"{folder}/f.cap", sample(100))
    lanes = capture.read_capture(spark, listing.list_files(spark, folder))
    assert lanes.filter("msg_type_code = 78").count() == 10
    assert lanes.filter("msg_type_code = 90 AND stream_id < 9").count() < 10
    assert lanes.count() == 100


def test_discovery(spark, folder):
    for name in ("efvi_1_1.cap.tar.xz", "efvi_1_16641.cap.tar.xz", "x.cap", "y.txt"):
        write(f"{folder}/{name}", [b"x"])
    fo = listing.discover_archives(spark, folder, "*.cap.tar.xz", exclude=r"_166[^/]*\.cap\.tar\.xz$")
    assert [row.archive_stem for row in fo.collect()] == ["efvi_1_1"]
    cm = listing.discover_archives(spark, folder, "*_166*.cap.tar.xz")
    assert [row.archive_stem for row in cm.collect()] == ["efvi_1_16641"]
    for name in ("sub/k=1/a.cap.tar.xz", "sub/other/b.cap.tar.xz", "k=2/c.cap", "d.cap.tar.xz.dir/e.txt"):
        write(f"{folder}/{name}", [b"x"])
    assert listing.discover_archives(spark, folder, "*.cap.tar.xz").count() == 2
    assert listing.list_files(spark, folder).count() == 4
    assert listing.list_files(spark, folder, "*.cap.tar.xz", recursive=True).count() == 4
    assert listing.list_files(spark, f"file:{folder}/", "*.cap").count() == 1
    with pytest.raises(FileNotFoundError):
        listing.discover_archives(spark, folder, "*.none")
    assert listing.discover_archives(spark, folder, "*.none", required=False).count() == 0


@pytest.mark.parametrize("files, pick", [
    ([("recovery_efvi_1.cap", 5), ("stitched_efvi_1.cap", 5)], "recovery_efvi_1.cap"),
    ([("recovery_efvi_1.cap", 4), ("stitched_efvi_1.cap", 5)], "stitched_efvi_1.cap"),
    ([("recovery_efvi_1.cap", 9), ("recovery_efvi_2.cap", 1), ("stitched_efvi_9.cap", 8)], "recovery_efvi_1.cap"),
    ([("stitched_efvi_2.cap", 1)], "stitched_efvi_2.cap"),
    ([("recovery_efvi_2.cap", 1), ("x.cap", 99)], "recovery_efvi_2.cap"),
    ([("x.cap", 1), ("recovery_efvi_2.tar", 5)], None),
])
def test_capture_choice(spark, files, pick):
    df = spark.createDataFrame([("/d/" + name, size) for name, size in files], "path string, length bigint")
    assert [row.path for row in listing.choose_capture(df).collect()] == ([] if pick is None else ["/d/" + pick])


@pytest.mark.parametrize("form", ["archive", "blocks"])
@pytest.mark.parametrize("size", [0, 1, 512, 513, 100_000])
def test_archives_are_written_piece_by_piece(folder, form, size):
    data = os.urandom(size)
    writer = capture_files.CaptureFileWriter(folder, form, b"", False, 7000)
    written, final = writer.write_file("e_1", iter([data[at:at + 999] for at in range(0, size, 999)]))
    packed = open(written, "rb").read()
    with tarfile.open(fileobj=io.BytesIO(lzma.decompress(packed))) as archive:
        member, = archive.getmembers()
        assert (member.name, archive.extractfile(member).read()) == ("e_1.cap", data)
    assert final.endswith("/e_1.cap.tar.xz") and packed.startswith(b"\xfd7zXZ")


@pytest.mark.parametrize("form", ["archive", "blocks"])
def test_writing_an_archive_holds_little_of_it(folder, form):
    writer = capture_files.CaptureFileWriter(folder, form, b"", False, 1 << 16)
    pieces = (bytes([at]) * 200_000 for at in range(200))
    tracemalloc.start()
    try:
        writer.write_file("e_1", pieces)
        assert tracemalloc.get_traced_memory()[1] < 8_000_000
    finally:
        tracemalloc.stop()


def test_parts_cheaper_than_an_opened_file_share_tasks():
    parts = [(capture.CaptureSplit("/a.cap.tar.xz", at, 700, at, 1 << 40), 50_000) for at in range(20_000)]
    tasks = capture.bundles(parts, 50_000, 100_000, 12)
    assert 12 <= len(tasks) <= 400
    assert sorted(split.first for task in tasks for split in task.splits) == list(range(20_000))
    assert len(capture.bundles(parts[:40], 50_000, 100_000, 12)) == 40
