from chapterloom.sources import files


def test_tasks_and_batches_are_bounded_by_bytes(tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BYTES_A_TASK", 1000)
    monkeypatch.setattr(files, "BYTES_A_BATCH", 300)
    want = {f"b{k}/x.txt": "검" * (50 if k else 900) for k in range(12)}
    for name, text in want.items():
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text(text)
    reader = files._Reader(str(tmp_path), "*/x.txt")
    tasks = reader.partitions()
    assert sorted(len(t.names) for t in tasks) == [1, 5, 6]  # the first file is larger than a task's share
    batches = [b for t in tasks for b in reader.read(t)]
    assert max(b.num_rows for b in batches) == 2 and len(batches) == 1 + 3 + 3
    assert {r["path"]: r["content"] for b in batches for r in b.to_pylist()} == want
