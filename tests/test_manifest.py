"""The manifest data source, and what is written for it."""

import json
import os

import pytest

from heartwood.operators import ingest
from heartwood.sources import manifest, readers


def put(path, body):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body) if isinstance(body, str) else path.write_bytes(body)


def test_paths(spark, tmp_path):
    put(tmp_path / "m/a/f1.txt", "beside")
    put(tmp_path / "up.txt", "above")
    put(tmp_path / "work/f1.txt", "work folder")
    put(tmp_path / "work/f2.txt", "second")
    put(tmp_path / "root/f2.txt", "third")
    put(tmp_path / "root/f3.txt", "root only")
    put(tmp_path / "m/big.txt", "x" * 101)
    put(tmp_path / "m/edge.txt", "x" * 100)
    put(tmp_path / "m/bad.txt", b"\xff\xfe\xff")
    put(tmp_path / "m/mark.txt", b"\xef\xbb\xbfmark")
    (tmp_path / "m/folder").mkdir()
    want = {
        "a/f1.txt": ("beside", None), "../m/a/f1.txt": ("beside", None), "./a/../a/f1.txt": ("beside", None), "../up.txt": ("above", None), "f1.txt": ("work folder", None), "f2.txt": ("second", None), "f3.txt": ("root only", None),
        f"{tmp_path}/root/f2.txt": ("third", None), f"file://{tmp_path}/root/f2.txt": ("third", None), "big.txt": (None, "file too large"), "edge.txt": ("x" * 100, None), "bad.txt": (None, "file is not UTF-8"), "mark.txt": ("mark", None),
        "none.txt": (None, "file not found"), "../../../none.txt": (None, "file not found"), "folder": (None, "file not found"), None: (None, "no file"), "": (None, "no file"),
    }
    put(tmp_path / "m/m.json", json.dumps({"default_significance": 0.7, "figures": [{"name": "ann", "pronoun": "she", "sources": [{"file": f} for f in want]}, {"name": "bea", "sources": []}, {"name": "cid"}]}))
    for path in (f"{tmp_path}/m/m.json", f"file://{tmp_path}/m/m.json"):
        df = manifest.documents(spark, path, [f"{tmp_path}/work", f"{tmp_path}/root"], 100)
        rows = df.collect()
        assert {r["file"]: (r["text"], r["error"]) for r in rows} == want and len(rows) == len(want)
        assert df.rdd.getNumPartitions() == len(want)  # one for each named file
    assert [r["source_ord"] for r in sorted(rows, key=lambda r: r["source_ord"])] == list(range(len(want)))


def test_fields_and_their_defaults(spark, tmp_path):
    put(tmp_path / "a.txt", "A text.")
    sources = [{"file": "a.txt"}, {"file": "a.txt", "doc_type": "letter", "pub_year": 1800, "significance": 0.2, "translation": True, "title": "T"}]
    put(tmp_path / "in/one.json", json.dumps({"figures": [{"name": "ann", "sources": [{**s, "file": "../a.txt"} for s in sources]}]}))
    put(tmp_path / "in/two.json", json.dumps({"default_significance": 1, "figures": [{"name": "bea", "pronoun": "he", "sources": [{"file": "../a.txt", "translation": False}]}]}))
    put(tmp_path / "in/notes.txt", "not a manifest")
    rows = sorted(readers.manifest_documents(spark, f"{tmp_path}/in").collect(), key=lambda r: (r["figure"], r["source_ord"]))
    got = [(r["figure"], r["pronoun"], r["doc_type"], r["pub_year"], r["significance"], r["is_translation"], r["doc_title"], r["text"]) for r in rows]
    assert got == [("ann", "unknown", "unknown", None, None, None, "", "A text."), ("ann", "unknown", "letter", 1800, 0.2, True, "T", "A text."), ("bea", "he", "unknown", None, 1.0, False, "", "A text.")]


@pytest.mark.parametrize(("name", "body", "said"), [("m.json", "{broken", "not valid JSON"), ("none.json", None, "not found")])
def test_a_manifest_that_cannot_be_read_is_an_error(spark, tmp_path, name, body, said):
    if body:
        put(tmp_path / name, body)
    with pytest.raises(Exception, match=said):
        manifest.documents(spark, f"{tmp_path}/{name}").collect()


def test_unnamed_files_are_never_opened(spark, tmp_path):
    put(tmp_path / "a.txt", "named")
    os.mkfifo(tmp_path / "pipe")  # opening it would wait for ever
    put(tmp_path / "m.json", json.dumps({"figures": [{"name": "ann", "sources": [{"file": "a.txt"}]}]}))
    assert [r["text"] for r in manifest.documents(spark, f"{tmp_path}/m.json").collect()] == ["named"]


def test_written_and_read_back(spark, tmp_path):
    rows = [(f"fig{i % 3}", "she", f"d{i % 4}/f{i}.txt", "letter", 1900 + i if i % 2 else None, f"The text of number {i} is long enough to count as one." if i % 5 else None) for i in range(40)]
    docs = spark.createDataFrame(rows, "figure string, pronoun string, file string, doc_type string, pub_year int, text string")
    made = manifest.write(docs, f"{tmp_path}/out", 6)
    for _ in range(2):  # a second run writes the same files
        assert sum(r["files"] for r in made.collect()) == 40
    got = manifest.documents(spark, f"{tmp_path}/out/manifests").collect()
    assert sorted((r["figure"], r["pronoun"], r["file"], r["doc_type"], r["pub_year"], r["text"]) for r in got if r["text"]) == sorted((r[0], r[1], f"../texts/{r[2]}", *r[3:]) for r in rows if r[5])
    assert {r["file"] for r in got if r["error"] == "file not found"} == {f"../texts/{r[2]}" for r in rows if not r[5]}
    passages, errors = ingest.batch(manifest.documents(spark, f"{tmp_path}/out/manifests"), 1e9)
    assert passages.count() == 32 and errors.count() == 8
