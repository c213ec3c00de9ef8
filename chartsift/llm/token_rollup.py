"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are additive, so changes arrive as signed rows: an insert is +1, a
delete -1, a revision the old text at -1 and the new one at +1. A batch is aggregated to one signed row for each group
and committed once under its id: a commit that comes again changes nothing, and one that was lost half-way is redone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, cut, shared_path, table

KEYS = ("source", "lang", "tokenizer")
PIECE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def words_1(text: Column) -> Column:
    """Runs of characters between ASCII blanks."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def pieces_1(text: Column) -> Column:
    """Runs of letters, runs of digits, and every other mark on its own."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(PIECE)).cast("long")


def vocabulary_file(path: str) -> Callable[[Column], Column]:
    """A counter for a public tokenizer's vocabulary file: ``.model`` (pieces), ``.json`` (tokenizers) or ``.tiktoken``.

    The path is the caller's and must be readable on every worker; the file is loaded once per worker process. Nothing
    is trained. Whole texts are encoded; null counts as empty.
    """
    loaded: dict[str, Callable[[str], int]] = {}

    def load() -> Callable[[str], int]:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            return lambda t: len(model.encode(t))
        if path.endswith(".json"):
            import tokenizers

            model = tokenizers.Tokenizer.from_file(path)
            return lambda t: len(model.encode(t, add_special_tokens=False).ids)
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe

        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        model = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
        return lambda t: len(model.encode_ordinary(t))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        f = loaded.get(path) or loaded.setdefault(path, load())
        return pd.Series([f(t or "") for t in texts], dtype="int64")

    return count


TOKENIZERS: dict[str, Callable[[Column], Column]] = {"words-1": words_1, "pieces-1": pieces_1}


def counts(text: Column, tokenizers: dict[str, Callable[[Column], Column]] = TOKENIZERS) -> Column:
    """Array of a text's token counts, one for each tokenizer."""
    return F.array(*[f(text).cast("long") for f in tokenizers.values()])


def signed(docs: DataFrame, sign: int, tokenizers: dict[str, Callable[[Column], Column]] = TOKENIZERS, counted: str | None = None) -> DataFrame:
    """Rows of ``docs`` as changes ``(source, lang, counts, sign)``; ``counted`` names a column of counts made before, so that
    changes picked by a join need not carry their texts through it."""
    return docs.select("source", "lang", (F.col(counted) if counted else counts(F.col("text"), tokenizers)).alias("counts"), F.lit(sign).cast("long").alias("sign"))


def deltas(changes: DataFrame, tokenizers: dict[str, Callable[[Column], Column]] = TOKENIZERS) -> DataFrame:
    """``(source, lang, tokenizer, n_docs, n_tokens)``: the signed sums of a batch.

    Partial sums before the shuffle make a hot source one row for each map task. Null sources and languages are groups
    of their own; null and empty texts count 0 tokens; an empty batch has no rows; extra columns play no part.
    """
    sums = changes.groupBy("source", "lang").agg(F.sum("sign").alias("n_docs"), *[F.sum(F.col("sign") * F.get("counts", i)).alias(f"n{i}") for i in range(len(tokenizers))])
    rows = F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.col(f"n{i}").alias("n_tokens")) for i, v in enumerate(tokenizers)])
    return sums.select("source", "lang", "n_docs", F.explode(rows).alias("x")).select("source", "lang", "x.tokenizer", "n_docs", "x.n_tokens")


class Rollup:
    """A rollup in a folder that driver and executors share: a Parquet folder of rows for each attempt at a batch, and a
    marker file ``commit-<batch>`` that names the one that counts."""

    SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _marker(self, batch: str) -> str:
        if not batch or set(batch) & set("/=\\") or batch.startswith((".", "_")):
            raise ValueError(f"not a batch id: {batch!r}")
        return f"{self.path}/commit-{batch}"

    def committed(self, batch: str) -> bool:
        fs, p = self._fs(self._marker(batch))
        return fs.exists(p) and fs.getFileStatus(p).getLen() > 0

    def commit(self, batch: str, delta: DataFrame) -> bool:
        """Adds a batch once; False (and nothing is computed) if the id is there already.

        The rows are written aside; then the marker is created, which the file system grants to one writer alone, so of two
        attempts at a time one counts. An attempt that is lost before its marker is written leaves rows that no total reads;
        one lost while it writes the marker leaves an empty one, which is taken away by the next.
        """
        if self.committed(batch):
            return False
        name = f"rows-{uuid.uuid4().hex}"
        delta.select("source", "lang", "tokenizer", "n_docs", "n_tokens").write.parquet(f"{self.path}/{name}")
        fs, p = self._fs(self._marker(batch))
        if fs.exists(p) and fs.getFileStatus(p).getLen() == 0:
            fs.delete(p, False)
        try:
            out = fs.create(p, False)
        except Py4JJavaError:
            if not fs.exists(p):
                raise
            fs.delete(self._fs(f"{self.path}/{name}")[1], True)
            return False
        out.write(bytearray(name.encode()))
        out.close()
        return True

    def totals(self) -> DataFrame:
        """Sums over all committed batches; groups without documents and tokens are left out."""
        fs, p = self._fs(self.path)
        names = []
        for s in fs.listStatus(p) if fs.exists(p) else []:
            if s.getPath().getName().startswith("commit-") and s.getLen():
                stream = fs.open(s.getPath())
                names.append(f"{self.path}/{bytes(stream.readAllBytes()).decode()}")
                stream.close()
        rows = self.spark.read.schema(self.SCHEMA).parquet(*names) if names else self.spark.createDataFrame([], self.SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")


def op2_token_rollup(spark, sf_dir: str) -> DataFrame:
    """The rollup after four commits over the whole of ``documents`` and ``labels``: all documents come in; the toxic ones
    are revised to a text without punctuation; those of low quality are deleted (as they then stand); and the
    revision's commit comes again, which must change nothing."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rollup = Rollup(spark, shared_path(spark, "rollup"))
    toxic, low = labels.where("toxic = 1").select("doc_id").distinct(), labels.where("quality = 0").select("doc_id").distinct()
    plain = F.regexp_replace("text", r"[.,;:!?]", "")
    # counted once, in a narrow pass over the texts; what follows moves a few numbers for each document
    rows = cut(docs.select("doc_id", "source", "lang", counts(F.col("text")).alias("old"), counts(plain).alias("new")))
    revised = rows.join(toxic, "doc_id", "left_semi")
    revision = signed(revised, -1, counted="old").unionByName(signed(revised, 1, counted="new"))
    gone = rows.join(low, "doc_id", "left_semi").join(toxic.withColumn("t", F.lit(True)), "doc_id", "left").withColumn("now", F.when(F.col("t"), F.col("new")).otherwise(F.col("old")))
    rollup.commit("1", deltas(signed(rows, 1, counted="old")))
    rollup.commit("2", deltas(revision))
    rollup.commit("3", deltas(signed(gone, -1, counted="now")))
    rollup.commit("2", deltas(revision))
    return rollup.totals()


ORACLE_SQL = r"""
WITH d AS (SELECT source, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN regexp_replace(coalesce(text, ''), '[.,;:!?]', '', 'g') ELSE coalesce(text, '') END AS text
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)),
n AS (SELECT source, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\t\n\x0B\f\r \p{L}\p{N}]')) AS p FROM d)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs, CAST(sum(w) AS BIGINT) AS n_tokens FROM n GROUP BY source, lang
UNION ALL SELECT source, lang, 'pieces-1', count(*), CAST(sum(p) AS BIGINT) FROM n GROUP BY source, lang
"""
