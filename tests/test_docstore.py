"""Collections of documents: synchronised whole and in part, built for some clinics."""

from brindle.sources.docstore import Collection, DocumentStore, build
from brindle.sources.state import Store


def test_documents(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    docs = DocumentStore(store)
    of = lambda *rows: spark.createDataFrame([*rows], "_id string, site string, n int")
    assert docs.count("p") == 0 and docs.sync("p", of(("a", "x", 1), ("b", "x", 1))) == {"inserted": 2}
    assert docs.sync("p", of(("a", "x", 2), ("c", "y", 1)), partial=True) == {"updated": 1, "inserted": 1, "unchanged": 1}
    assert docs.count("p") == 3 and docs.get("p", "a").n == 2 and docs.get("p", "z") is None
    assert docs.sync("p", of(("c", "y", 1))) == {"unchanged": 1, "deleted": 2}
    assert [r._id for r in docs.find("p", "site = 'y'").collect()] == ["c"]
    store.publish({"rows": of(("a", "x", 1), ("b", "y", 1))})
    known = {"p": Collection("p", ("rows",), lambda rows: rows, "site"), "w": Collection("w", ("rows",), lambda rows: rows)}
    assert build(docs, known, dry_run=True) == {"p": {"documents": 2}, "w": {"documents": 2}} and docs.count("w") == 0
    assert build(docs, known, sites=["x"]) == {"p": {"inserted": 1, "unchanged": 1}, "w": {"skipped": "spans clinics"}}
    assert build(docs, known, ["w"]) == {"w": {"inserted": 2}} and docs.count("p") == 2
    docs.to_files("p", str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
