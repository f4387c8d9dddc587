"""What retrieval finds ready: contents as a stored collection and its indexes, made once for a folder of tables and session.

A retrieval service answers from what indexing has written; so do the catalogue's queries. The first that needs a part
makes it, from whole tables, in the folder that driver and executors share; it goes when the driver ends.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import embedding
from ..operators.collections import Store
from ..operators.lexical_index import BlockIndex
from ..operators.vector_index import VectorIndex
from ..sources.shared import files_of, shared_dir

COLLECTION = "contents"
_made: dict[tuple[str, str], Prepared] = {}


class Prepared:
    def __init__(self, corpus: DataFrame):
        self.spark, self.corpus = corpus.sparkSession, corpus
        self.root = f"{shared_dir(self.spark)}/workbench-{uuid.uuid4().hex}"
        files, where = files_of(self.spark, self.root)
        files.mkdirs(where)
        files.deleteOnExit(where)

    @cached_property
    def store(self) -> Store:
        """With the corpus as a collection, whole texts embedded."""
        store = Store(self.spark, f"{self.root}/store")
        store.replace(COLLECTION, embedding.embed(self.corpus, "document", embedding.WHOLE_MODEL, kind="double"))
        return store

    @property
    def collection(self) -> DataFrame:
        return self.store.read(COLLECTION)

    @cached_property
    def lexical(self) -> BlockIndex:
        return BlockIndex.build(self.corpus, f"{self.root}/lexical")

    @cached_property
    def vectors(self) -> VectorIndex:
        return VectorIndex.build(self.collection, f"{self.root}/vectors")


def prepared(spark: SparkSession, sf_dir: str, corpus: DataFrame) -> Prepared:
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _made:
        _made[key] = Prepared(corpus)
    return _made[key]
