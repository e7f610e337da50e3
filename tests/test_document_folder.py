"""Repeated scans of a folder of documents."""

import os

from wattloom.sources.document_folder import DocumentFolder
from wattloom.sources.documents import scan_documents


def put(root, name, text, age=0):
    file = root / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(text, encoding="utf-8")
    os.utime(file, (1_700_000_000 - age, 1_700_000_000 - age))
    return file


def held(folder):
    return {r.relative_path: (r.content, r.scan) for r in folder.documents().collect()}


def test_scans_read_what_is_new_or_changed(spark, tmp_path):
    root = tmp_path / "in"
    for named in (10_000, 0):
        put(root, "energy/a.md", "first"), put(root, "energy/b c+ü.txt", "second\nline"), put(root, "gone.md", "x"), put(root, "other.pdf", "no")
        folder = DocumentFolder(spark, str(root), str(tmp_path / f"state{named}"), named_files=named)
        assert held(folder) == {}
        assert folder.scan() == {"read": 3, "dropped": 0}
        assert held(folder) == {"energy/a.md": ("first", 0), "energy/b c+ü.txt": ("second\nline", 0), "gone.md": ("x", 0)}
        assert folder.scan() == {"read": 0, "dropped": 0}
        put(root, "energy/a.md", "First")  # same size, same time: not seen
        assert folder.scan() == {"read": 0, "dropped": 0}
        put(root, "energy/a.md", "FIRST", age=-5)
        put(root, "late/old.md", "old", age=90_000), put(root, "late/empty.md", "")  # new here, though older than all others
        (root / "gone.md").unlink()
        assert folder.scan() == {"read": 2, "dropped": 2}
        assert held(folder) == {"energy/a.md": ("FIRST", 3), "energy/b c+ü.txt": ("second\nline", 0), "late/old.md": ("old", 3)}
        put(root, "gone.md", "back")
        assert folder.scan() == {"read": 1, "dropped": 0}
        assert held(folder)["gone.md"] == ("back", 4)
        (root / "late" / "old.md").unlink()


def test_a_scan_that_broke_off_is_done_anew(spark, tmp_path):
    root, state = tmp_path / "in", tmp_path / "state"
    put(root, "a.md", "one")
    folder = DocumentFolder(spark, str(root), str(state))
    folder.scan()
    put(root, "a.md", "other")
    folder.scan()
    commit = state / "commits" / "scan=1"
    for file in commit.iterdir():
        file.unlink()
    commit.rmdir()
    assert held(folder) == {"a.md": ("one", 0)}
    put(root, "b.md", "more")
    assert folder.scan() == {"read": 2, "dropped": 1}
    assert held(folder) == {"a.md": ("other", 1), "b.md": ("more", 1)}


def test_only_files_named_by_the_scan_are_opened(spark, tmp_path):
    root = tmp_path / "in"
    put(root, "a.md", "one"), put(root, "b.md", "two")
    folder = DocumentFolder(spark, str(root), str(tmp_path / "state"))
    folder.scan()
    put(root, "b.md", "three")
    changed = folder._files("listing").where("file_url like '%b.md'")
    contents = folder._contents(changed)
    contents.collect()
    plan = contents._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):  # the first branch reads the text
        plan = plan.children().apply(0)
    assert plan.metrics().apply("numFiles").value() == 1
    listing = folder._files("listing")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in listing.split("ReadSchema")[1]


def test_the_path_below_a_root_whose_name_comes_twice(spark, tmp_path):
    root = tmp_path / "docs" / "a.b" / "docs"
    put(root, "docs/x y.md", "text")
    assert [r.relative_path for r in scan_documents(spark, str(root) + "/").collect()] == ["docs/x y.md"]
    assert [r.relative_path for r in scan_documents(spark, f"file://{root}").collect()] == ["docs/x y.md"]


def test_many_small_files_make_few_tasks(spark, tmp_path):
    root = tmp_path / "small"
    root.mkdir()
    for i in range(120):
        (root / f"{i}.txt").write_text(f"text {i}")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "16m")
    try:
        folder = DocumentFolder(spark, str(root), str(tmp_path / "small-state"))
        assert folder.scan() == {"read": 120, "dropped": 0}
        assert spark.conf.get(names[1]) == before[1]
    finally:
        spark.conf.set(names[0], before[0])
    written = list((tmp_path / "small-state" / "files" / "scan=0").glob("*.parquet"))
    assert len(written) <= 16  # at Spark's own cost of opening a file, a task reads four
    assert sorted(r.content for r in folder.documents().collect()) == sorted(f"text {i}" for i in range(120))
