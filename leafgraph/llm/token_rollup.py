"""Token counts kept as delta-maintained rollups.

Changes of documents become signed rows: an insert adds a document and its tokens, a delete takes them away, a revised
count adds the difference.  A batch of changes is added up by source, language and tokenizer version and written once
under its own name; committing a name again changes nothing.  Totals are the sum over committed batches, so batches may
arrive in any order, and old ones can be folded into one.
"""

from __future__ import annotations

import base64
import re
import uuid
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that the published ranks were made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ("source", "lang", "tokenizer")
_SHAPE = "source string, lang string, tokenizer string, docs long, tokens long"


#: A longer run of white space does not go through the split pattern, whose look-ahead would overflow its stack there.
LONG_RUN = 10_000
# Fixed value: what that pattern takes for white space (the Unicode property White_Space).
_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


@lru_cache(maxsize=4)
def _encodings(ranks_file: str):
    """The encoding, and one that takes a whole text for one piece."""
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tuple(tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (PATTERN, r"[\s\S]+"))


def n_tokens(text: str | None, ranks_file: str = DEFAULT_RANKS) -> int:
    """The number of byte-level BPE tokens of a text, however long its runs of white space are.

    A run is a piece of its own up to its last character, and that one goes with what follows (at the end of the text the
    run is one piece), so cutting there leaves the pieces what they are.
    """
    if not text:
        return 0
    split, whole = _encodings(ranks_file)
    total, at = 0, 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(split.encode_ordinary(text[at : run.start()])) + len(whole.encode_ordinary(text[run.start() : end]))
        at = end
    return total + len(split.encode_ordinary(text[at:] if at else text))


def count_tokens(text: Column, ranks_file: str = DEFAULT_RANKS) -> Column:
    """``n_tokens`` of a text column; null and empty texts have none."""

    @pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: n_tokens(t, ranks_file), na_action=None)

    return count(text)


def inserts(counts: DataFrame, tokenizer: str, tokens: str = "tokens") -> DataFrame:
    """Signed rows that add each row of ``counts(source, lang, <tokens>)``."""
    return _signed(counts, tokenizer, F.lit(1), F.col(tokens))


def deletes(counts: DataFrame, tokenizer: str, tokens: str = "tokens") -> DataFrame:
    """Signed rows that take away each row of ``counts``."""
    return _signed(counts, tokenizer, F.lit(-1), -F.col(tokens))


def revisions(counts: DataFrame, tokenizer: str, before: str, after: str) -> DataFrame:
    """Signed rows that replace the count ``before`` by the count ``after`` of documents that stay."""
    return _signed(counts, tokenizer, F.lit(0), F.coalesce(after, F.lit(0)) - F.coalesce(before, F.lit(0)))


def _signed(counts: DataFrame, tokenizer: str, docs: Column, tokens: Column) -> DataFrame:
    return counts.select(
        "source", "lang", F.lit(tokenizer).alias("tokenizer"), docs.cast("long").alias("docs"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"),
    )


class Rollup:
    """A rollup in a folder that all executors share.  A batch counts from the moment its folder has its final name."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, where = self._files(), self._path(folder)
        return [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []

    def _committed(self) -> set[str]:
        return {n.removeprefix("batch=") for n in self._names(self.root) if n.startswith("batch=")}

    def _folded(self, committed: set[str]) -> set[str]:
        """Batches that are part of a fold.  The list of a fold that was not committed has no effect."""
        folds = [n for n in self._names(f"{self.root}/folded") if n in committed or n in self._names(f"{self.root}/past")]
        return {name for fold in folds for name in self._names(f"{self.root}/folded/{fold}")}

    def batches(self) -> list[str]:
        """Names of the committed batches that totals are read from."""
        committed = self._committed()
        return sorted(committed - self._folded(committed))

    def commit(self, name: str, signed: DataFrame) -> bool:
        """Add up ``signed`` and commit it as batch ``name``.  False, and nothing done, if that name was committed before.

        Null sources and languages are groups of their own.  An empty batch is committed like any other.
        """
        if not name or "/" in name:
            raise ValueError(f"not a batch name: {name!r}")
        committed = self._committed()
        if name in committed | self._folded(committed):
            return False
        return self._publish(name, signed.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")))

    def _publish(self, name: str, sums: DataFrame) -> bool:
        written = f"{self.root}/_writing-{uuid.uuid4().hex}"
        sums.write.parquet(written)
        files = self._files()
        final = self._path(f"{self.root}/batch={name}")
        # a rename is one step: of two writers of the same name, one wins and the other's work is dropped
        if files.exists(final) or not files.rename(self._path(written), final):
            files.delete(self._path(written), True)
            return False
        stray = self._path(f"{self.root}/batch={name}/{written.rpartition('/')[2]}")
        if files.exists(stray):  # the other writer was first, and this one was moved into its folder
            files.delete(stray, True)
            return False
        return True

    def _sums(self, names: list[str]) -> DataFrame:
        paths = [f"{self.root}/batch={b}" for b in names]
        read = self.spark.read.schema(_SHAPE)
        all_ = read.parquet(*paths) if paths else self.spark.createDataFrame([], _SHAPE)
        sums = all_.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens`` over all committed batches; groups that sum up to nothing are left out.

        The batches are those committed when this is called.  If a fold deletes one before the frame is read, reading fails.
        """
        return self._sums(self.batches())

    def fold(self, break_lock: bool = False) -> bool:
        """Replace the committed batches by one with their totals.  Their names stay known and can't be committed again.

        The fold counts, and the batches it lists stop to count, from the moment it is committed; only then they are
        deleted.  A batch that is committed meanwhile is not part of it.  One fold runs at a time: False, and nothing done,
        while another holds the lock (``break_lock``: that one is known to be dead), if the fold could not be committed, or
        if there is nothing to fold.
        """
        files, lock = self._files(), self._path(f"{self.root}/fold.lock")
        if break_lock:
            files.delete(lock, False)
        if not files.createNewFile(lock):
            return False
        try:
            names = self.batches()
            if len(names) < 2:
                return False
            fold = f"fold-{uuid.uuid4().hex}"
            for name in names:
                files.create(self._path(f"{self.root}/folded/{fold}/{name}"), True).close()
            if not self._publish(fold, self._sums(names)):
                files.delete(self._path(f"{self.root}/folded/{fold}"), True)
                return False
            for name in names:
                if name.startswith("fold-"):
                    files.create(self._path(f"{self.root}/past/{name}"), True).close()
                files.delete(self._path(f"{self.root}/batch={name}"), True)
            return True
        finally:
            files.delete(lock, False)
