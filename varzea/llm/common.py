"""What several operators share: the shared folder, materialised tables, and byte-array views of texts."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or where that is unset (local tests) a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="varzea-")
        spark.sparkContext.setCheckpointDir(_OWN[app])
    return _OWN[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/varzea-{name}-{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, path)
    return path


def release(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a materialised table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/varzea-" in path:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Best effort: at exit the JVM may be gone already."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001
        pass


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write to the shared folder and read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def held_by(col, n: int, rest: int):
    """Whether the id falls in the held-out fold; a null id does not."""
    return F.coalesce(crc_mod(col, n) == rest, F.lit(False))


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About `bound` rows, chosen by a hash of the key: the same rows whatever the partitioning."""
    n = df.count()
    if n <= bound:
        return df
    cut = int(bound / n * 1_000_000) + 1
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1_000_000)) < F.lit(cut))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, label, text) of about `bound` ids, chosen by a hash, that have a label of 0 or 1. The labels are sampled first, so
    that no text is shuffled but those; an id with several labels has the largest, one with several texts the largest."""
    named = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    sample = bounded_sample(named, "doc_id", bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # about `bound` rows of two numbers
    return rows.groupBy("doc_id", label).agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))


#: white space of the contracts: \x20 and \x09-\x0D
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: lower-cases A-Z and leaves every other byte of UTF-8 alone
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: a separator of terms: ASCII that is no letter, digit or apostrophe
PUNCT = np.array([b < 128 and not (chr(b).isalnum() or b == 39) for b in range(256)])

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
STRETCH = 2_000_000  # bytes that are hashed at once
_POWERS = np.cumprod(np.full(4096, _MULT, dtype=np.uint64), dtype=np.uint64)  # of the places 0 to 4095 in a word


def powers(at: np.ndarray) -> np.ndarray:
    """What the byte at each place of a word counts: the multiplier to the power of the place plus one."""
    out = _POWERS[at & 4095]
    if len(at) and (most := int(at.max()) >> 12):
        high = np.cumprod(np.full(most + 1, _POWERS[-1], dtype=np.uint64), dtype=np.uint64)  # of whole stretches of 4096 places
        far = at >> 12 > 0
        out[far] *= high[(at[far] >> 12) - 1]
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of several texts in one byte array: start, end, text index and a 64-bit hash of each word."""

    def __init__(self, texts: list[bytes], separators: np.ndarray = SPACE):
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.bytes = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside = ~separators[self.bytes]
        edge = np.diff(inside.astype(np.int8), prepend=0)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.text = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.per_text = np.bincount(self.text, minlength=len(texts)) if len(texts) else np.zeros(0, dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.per_text)])

    def hashes(self) -> np.ndarray:
        """Of each word; a stretch of about STRETCH bytes at a time, a longer word in parts."""
        out = np.empty(len(self.start), dtype=np.uint64)
        length = self.end - self.start
        upto = np.cumsum(length)
        i = 0
        while i < len(length):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] - length[i] + STRETCH, side="right")))
            size = length[i:j]
            if size[0] > STRETCH:
                total = np.zeros(1, dtype=np.uint64)
                for a in range(0, int(size[0]), STRETCH):
                    b = self.bytes[self.start[i] + a : min(self.start[i] + a + STRETCH, self.end[i])]
                    total += (_BYTE[b] * powers(np.arange(a, a + len(b)))).sum(dtype=np.uint64)
            else:
                begin = np.cumsum(size) - size
                at = np.arange(int(size.sum())) - np.repeat(begin, size)
                total = np.add.reduceat(_BYTE[self.bytes[at + np.repeat(self.start[i:j], size)]] * powers(at), begin)
            out[i:j] = mix(total + size.astype(np.uint64))
            i = j
        return out


def chunks(texts, budget: int = 2_000_000):
    """Slices of a list of texts that hold about `budget` bytes each (one text at least)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > budget:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes; null is empty."""
    return [b"" if t is None else t.encode("utf-8") for t in column.to_pylist()]


_BLANK = re.compile(rb"[\x09-\x0D ]")


def blank_near(text: bytes, begin: int, stop: int) -> int:
    """The last white space byte in (begin, stop), else the first one from stop on, else the end of the text."""
    last = max(text.rfind(bytes([b]), begin + 1, stop) for b in np.flatnonzero(SPACE).tolist())
    if last > begin:
        return last
    m = _BLANK.search(text, stop)
    return m.start() if m else len(text)


def pieces(texts: list[bytes], limit: int = 1_000_000) -> tuple[list[bytes], np.ndarray]:
    """Cut texts at white space into parts of about `limit` bytes, so that arrays stay small; and each part's text. A longer word stays whole."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        begin = 0
        while len(t) - begin > limit:
            cut = blank_near(t, begin, begin + limit)
            if cut == len(t):
                break
            parts.append(t[begin:cut])
            owner.append(i)
            begin = cut
        parts.append(t[begin:] if begin else t)
        owner.append(i)
    return parts, np.array(owner, dtype=np.int64)


def hide(df: DataFrame, *own: str) -> tuple[DataFrame, dict[str, str]]:
    """Columns that an operator does not read itself get neutral names, so that they clash with none of its own; and the names."""
    names = {c: c if c in own else f"varzea_{i}" for i, c in enumerate(df.columns)}
    quote = lambda c: "`" + c.replace("`", "``") + "`"
    return df.select(*(F.col(quote(c)).alias(n) for c, n in names.items())), names


def show(names: dict[str, str], *without: str) -> list:
    """The columns under their own names again, but those in `without`, in whatever case."""
    gone = {w.lower() for w in without}
    return [F.col(n).alias(c) for c, n in names.items() if c.lower() not in gone]


def fields_of(df: DataFrame, columns: list[str]) -> str:
    """The columns as a schema string."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns)
