"""Folders of small files that tasks list, read and write themselves."""

import errno
import hashlib
import os

import pytest

import catalog.all_queries  # noqa: F401
from catalog.registry import run
from wattloom.session import scratch_path
from wattloom.sources import shared_files
from wattloom.sources.document_folder import DocumentFolder

ODD_NAMES = ("a.md", "b c+%20.txt", "ü　é.md", "q?#[x]{y}^`.txt", "UPPER.MD", "part=-1/_k=1/c.txt", "deep/er/d;e,f@g&h.md", "_metadata.md", "_metadata/m.md",
             "_left.md", ".left.md", "_left/x.md", "left._COPYING_", "empty.md", "other.pdf", "other.md.gz")


def folder_of(root, names):
    for i, name in enumerate(names):
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"" if name.startswith("empty") else f"text {i}\r\n\xff".encode("latin-1") if i == 1 else f"tëxt {i}\n".encode())
        os.utime(file, ns=(0, 1_700_000_000_000_000_000 + i * 1_234_567_891))
    os.symlink(root / "nowhere", root / "link.md")
    os.symlink(root / "self.md", root / "self.md")


def test_same_rows_as_sparks_readers(spark, tmp_path):
    root = tmp_path / "in x"
    folder_of(root, ODD_NAMES)
    folder = DocumentFolder(spark, str(root), str(tmp_path / "state"))
    assert folder._shared() == str(root)
    columns = ["file_url", "modified", "size", "cast(content as binary)"]  # a text need not be UTF-8
    by_readers = sorted(folder._files("contents").selectExpr(*columns).collect())
    assert len(by_readers) == 8
    files = shared_files.listed(spark, str(root)).where("file_url ilike '%.md' or file_url ilike '%.txt'")
    assert sorted(files.collect()) == sorted(folder._files("listing").collect())
    by_tasks = shared_files.contents(files)
    assert sorted(by_tasks.selectExpr(*columns).collect()) == by_readers
    assert folder.scan() == {"read": 8, "dropped": 0}
    folder._shared = lambda: None  # a state is carried on by either way of reading
    assert folder.scan() == {"read": 0, "dropped": 0}


def test_what_spark_must_read_is_left_to_it(spark, tmp_path):
    (tmp_path / "a.md").write_text("one")
    state = str(tmp_path / "state")
    assert DocumentFolder(spark, str(tmp_path), state, ("%.md.gz",))._shared() is None
    assert DocumentFolder(spark, str(tmp_path), state, ("%",))._shared() is None
    assert DocumentFolder(spark, str(tmp_path / "none"), state)._shared() is None
    assert DocumentFolder(spark, f"file://{tmp_path}/", state)._shared() == str(tmp_path)
    assert shared_files.shared_path(spark, "file:///") == "/"


def test_folders_are_dealt_until_there_are_enough(tmp_path):
    for a in range(3):
        for b in range(3):
            (tmp_path / f"{a}/{b}").mkdir(parents=True)
            (tmp_path / f"{a}/{b}/x.md").write_text("x")
        (tmp_path / f"{a}/y.md").write_text("y")
    for enough, dealt in ((1, 1), (2, 4), (4, 13), (100, 13)):
        found = shared_files.to_list(str(tmp_path), enough)
        assert len(found) == dealt
        files = [row[0] for folder in found for row in shared_files.files_in(*folder)]
        assert len(files) == len(set(files)) == 12


def test_what_goes_meanwhile_is_left_out(spark, tmp_path):
    assert list(shared_files.files_in(str(tmp_path / "gone"), True)) == []
    assert shared_files.read_file(shared_files.file_url(str(tmp_path / "gone.md"))) is None
    with pytest.raises(OSError) as fault:
        with shared_files.if_there():
            raise OSError(errno.EIO, "broken")
    assert fault.value.errno == errno.EIO


def test_written_files_replace_their_subfolders(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    layout = "value string, part long, slice long"

    def held():
        return sorted((str(f.parent.relative_to(tmp_path / "out")), f.read_bytes()) for f in (tmp_path / "out").rglob("*") if f.is_file())

    first = [("one", 1, 0), ("one", 1, 0), (None, 2, 0), ("zwei ü\n", 2, 0), ("minus", -3, 5)]
    shared_files.put_files(spark.createDataFrame(first, layout), root, ("part", "slice"), 2)
    kept = [("part=-3/slice=5", b"minus\n"), ("part=2/slice=0", b"\n"), ("part=2/slice=0", "zwei ü\n\n".encode())]
    assert held() == [kept[0], ("part=1/slice=0", b"one\n"), ("part=1/slice=0", b"one\n"), *kept[1:]]
    shared_files.put_files(spark.createDataFrame([("new", 1, 0), ("more", 1, 1)], layout), root, ("part", "slice"), 2)
    assert held() == [kept[0], ("part=1/slice=0", b"new\n"), ("part=1/slice=1", b"more\n"), *kept[1:]]
    assert not [f for f in os.listdir(tmp_path / "out") if f.startswith(".")]


def test_rescan_of_thousands_of_documents(spark, tmp_path):
    """One file for each document and nothing beside it; a chmod and a checksum file for each took most of the time."""
    rows = [(i, None if i == 14 else f"text {i} ü") for i in range(3000)] + [(11, "again"), (13, "again"), (15, "again"), (None, "lost")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    before = set(os.listdir(base := scratch_path(spark, "x").rsplit("/", 1)[0]))
    found = run("document_rescan", spark, str(tmp_path / "sf"))
    got = sorted(map(tuple, found.collect()))
    texts = [(i, t or "") for i, t in rows if i is not None]
    assert got == sorted((i, int(i % 10 in (1, 3)), len(t), hashlib.md5(t.encode()).hexdigest()) for i, t in texts)
    root, = (f for f in set(os.listdir(base)) - before if f.startswith("document-files"))
    assert sum(len(names) for _, _, names in os.walk(f"{base}/{root}")) == len(texts)
