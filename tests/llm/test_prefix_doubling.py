import prefix_doubling
from fixed import SF
from prefix_doubling import repeated_positions
from pyspark import cloudpickle

from varzea.llm import suffix_dedup

cloudpickle.register_pickle_by_value(prefix_doubling)  # the tasks do not see this folder


def test_plain_form_removes_the_same_bytes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 1500").select("doc_id", "text")
    gone = {}
    for r in repeated_positions(docs).collect():
        gone.setdefault(r["doc"], set()).update(range(r["at"], r["at"] + 50))
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect() if r["n_removed"]}
    assert got and got == {d: len(x) for d, x in gone.items()}
