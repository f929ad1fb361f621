"""A clustering that is kept on disk and takes batch after batch.

Tables of the index, changed together by one commit per batch: ``shingle_order`` (the counts that give the global
order of shingles, taken from the first batch and kept, so that prefixes of different batches agree),
``representatives`` (their texts, which take less room than their sets), ``prefixes`` (their index rows) and
``members``. A batch reads its own texts and joins the index; of earlier texts only those of
representatives that a new text may be linked to are hashed again. A replayed batch changes nothing.

Any fixed order is right; a shingle that became common later is merely no longer sorted as such.
``reorder`` takes the order anew from the representatives kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ortholake.operators import seqsets
from ortholake.operators.similarity import ORDER, linked, measured, prefixes, sizes_allow
from ortholake.session import materialise
from ortholake.sinks.manifest import Change, VersionedTables


class ClusterIndex:
    def __init__(self, spark: SparkSession, root: str, n: int = seqsets.SEARCH_NGRAM, percent: int = seqsets.CLUSTER_PERCENT,
                 unit: str = "word", id_type: T.DataType | None = None):
        self.tables, self.n, self.percent, self.unit, self.id_type = VersionedTables(spark, root), n, percent, unit, id_type

    def _schema(self, name: str) -> T.StructType:
        key, long_ = self.id_type or T.LongType(), T.LongType()
        cols = {"representatives": [("id", key), ("text", T.StringType())], "prefixes": [("s", long_), ("id", key), ("n", long_)],
                "members": [("id", key), ("representative", key)]}
        return T.StructType.fromDDL(ORDER) if name == "shingle_order" else T.StructType([T.StructField(c, t) for c, t in cols[name]])

    def _read(self, name: str) -> DataFrame:
        return self.tables.read(name, self._schema(name))

    def members(self) -> DataFrame:
        """(id, representative) of every text so far."""
        return self._read("members")

    def start(self, clustered: DataFrame, tag: str = "start") -> bool:
        """Begin with a clustering: (id, text, representative)."""
        self.id_type = clustered.schema["id"].dataType
        reps = materialise(clustered.filter(F.col("id") == F.col("representative")).select("id", "text"), "representatives")
        order = measured(reps, self.n, self.unit)[1]
        return self.tables.commit({"shingle_order": order, "representatives": reps, "prefixes": self._prefixes(reps, order),
                                   "members": clustered.select("id", "representative")}, tag)

    def _prefixes(self, texts: DataFrame, order: DataFrame | None = None) -> DataFrame:
        return prefixes(texts, order if order is not None else self._read("shingle_order"), self.percent, self.n, self.unit)

    def matched(self, texts: DataFrame) -> DataFrame:
        """(id, representative): the smallest kept representative that each of ``texts`` (id, text) is linked to."""
        mine = self._prefixes(texts)
        kept = self._read("prefixes").select("s", F.col("id").alias("b"), F.col("n").alias("nb"))
        pairs = mine.join(kept, "s").filter(sizes_allow("n", "nb", self.percent)).select(F.col("id").alias("a"), "b").distinct()
        pairs = materialise(pairs, "pairs")
        links = linked(pairs, texts, self._read("representatives"), self.percent, self.n, self.unit)
        return links.groupBy("a").agg(F.min("b").alias("representative")).withColumnRenamed("a", "id")

    def add(self, batch: DataFrame, tag: str) -> bool:
        """Add texts (id, text): those linked to a kept representative join its cluster, the rest are
        clustered among themselves. Ids that the index has already are left alone."""
        if tag in self.tables.manifest()["tags"]:
            return False
        self.id_type = self.id_type or batch.schema["id"].dataType
        batch = materialise(batch.join(self.members().select("id"), "id", "left_anti").select("id", "text"), "batch")
        old = materialise(self.matched(batch), "matched")
        rest = materialise(batch.join(old.select("id"), "id", "left_anti"), "rest")
        new = materialise(seqsets.cluster_sequences(rest, "id", "text", n=self.n, percent=self.percent, unit=self.unit), "clustered")
        reps = materialise(rest.join(new.filter("id = representative").select("id"), "id", "left_semi"), "representatives")
        return self.tables.commit({"representatives": reps, "prefixes": self._prefixes(reps), "members": old.unionByName(new)}, tag)

    def reorder(self, tag: str) -> bool:
        """Take the order of shingles, and so all prefixes, anew from the representatives kept."""
        reps = self._read("representatives")
        order = measured(reps, self.n, self.unit)[1]
        return self.tables.commit({"shingle_order": Change(order, None), "prefixes": Change(self._prefixes(reps, order), None)}, tag)
