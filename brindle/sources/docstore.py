"""Collections of documents in a store: find, get, count, synchronise, replace, and build from a registry."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import merge
from ..operators.documents import bodies
from .files import to_json_lines
from .state import Store


class DocumentStore:
    """A collection is a table of documents with an ``_id`` each; every change is a new version of it."""

    def __init__(self, store: Store):
        self.store = store

    def _name(self, collection: str) -> str:
        return f"documents_{collection}"

    def find(self, collection: str, where: Column | str | None = None) -> DataFrame:
        docs = self.store.read(self._name(collection))
        return docs if where is None else docs.where(where)

    def get(self, collection: str, key: str):
        """One document, or None."""
        return self.find(collection, F.col("_id") == key).first()

    def count(self, collection: str) -> int:
        return self.find(collection).count() if self.store.exists(self._name(collection)) else 0

    def replace(self, collection: str, docs: DataFrame) -> None:
        self.store.publish({self._name(collection): docs})

    def sync(self, collection: str, docs: DataFrame, partial: bool = False) -> dict[str, int]:
        """Make the collection these documents; what is inserted, updated, unchanged, deleted.

        Documents are compared as canonical JSON. A partial build leaves what it doesn't have.
        """
        if not self.store.exists(self._name(collection)):
            self.replace(collection, docs)
            return {"inserted": self.count(collection)}
        old = self.find(collection)
        change = merge.synchronised(bodies(old), bodies(docs), partial)
        counts = {r.change: r.n for r in change.groupBy("change").agg(F.count("*").alias("n")).collect()}
        kept = old.join(docs.select(F.col("_id").alias("_k")), F.col("_id") == F.col("_k"), "left_anti") if partial else None
        self.replace(collection, docs if kept is None else docs.unionByName(kept, allowMissingColumns=True))
        return counts

    def to_files(self, collection: str, path: str) -> None:
        to_json_lines(self.find(collection), path)


@dataclass(frozen=True)
class Collection:
    """How documents are made of tables; ``site`` is the path of a document's clinic, if it is of one."""

    name: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    site: str | None = None


def build(documents: DocumentStore, known: Mapping[str, Collection], names: Sequence[str] | None = None, sites: Sequence[str] | None = None, dry_run: bool = False) -> dict[str, dict]:
    """Build collections from the store's tables, all or some, for all clinics or some.

    A build for some clinics is partial, and a collection that spans clinics is not built then.
    """
    out = {}
    for name in names or known:
        c = known[name]
        if sites and c.site is None:
            out[name] = {"skipped": "spans clinics"}
            continue
        docs = c.build(*map(documents.store.read, c.reads))
        docs = docs.where(F.col(c.site).isin(*sites)) if sites else docs
        out[name] = {"documents": docs.count()} if dry_run else documents.sync(name, docs, partial=bool(sites))
    return out
