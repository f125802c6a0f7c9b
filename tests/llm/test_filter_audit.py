import re
from collections import Counter
from itertools import permutations

from habiflow.llm import filter_audit as audit

SCHEMA = "doc_id long, text string, source string, n long, key string, live boolean"
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text, doc_id, rows):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = doc_id is not None and any((t or "") == text and i is not None and i < doc_id for i, t, _ in rows)
    return {f for f, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                                          bool(re.search(r"[#$%&*|]", text)), smaller)) if bad}


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {s or "" for _, _, s in rows}:
        docs = [(i, fails(t, i, rows)) for i, t, s in rows if (s or "") == part]
        share = Counter()
        for order in permutations("ABCDE"):
            for _, f in docs:
                share.update([next(x for x in order if x in f)] if f else [])
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [i for i, x in docs if f in x and not x & before]
                out[part, "".join(order), k + 1] = (
                    sum(not x & (before | {f}) for _, x in docs), len(here), sum(f in x and bool(x & before) for _, x in docs),
                    sum(x == {f} for _, x in docs), sum(i in good for i in here), sum(i in toxic for i in here), share[f])
    return out


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in df.collect()}


def write(spark, path, rows):
    """One file a row, in the order of the rows."""
    for r in rows:
        spark.createDataFrame([(*r, 1, "k", True)], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_op13_smaller_ids_retract_earlier_masks(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(220))
    rows = [(9, "copy #1", "a"), (7, "copy #1", "b"), (5, "copy #1", "a"), (5, "copy #1", "a"), (6, "copy #1", "b"), (None, "copy #1", "b"),
            (8, long, "a"), (3, long, None), (4, None, "a"), (2, "", ""), (1, "LOUD " * 300, "b"), (None, None, None)]
    labels = [(9, 1, 0), (7, 0, 1), (5, 1, 1), (8, 1, None), (3, None, 1), (3, 1, 0), (None, 1, 1), (77, 1, 1)]
    path = str(tmp_path / "documents.parquet")
    write(spark, path, rows)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute(rows, labels)
    for batches in (1, 4, 100):  # 100: a micro-batch a file, so ids come in the order above
        assert found(audit.interactions(audit.counters(spark, path, known, batches))) == want
    # ids 9, 7 and 5 came one after the other: the first two were taken back
    c = Counter()
    for r in audit.counters(spark, path, known, 100).collect():
        c[r["part"], r["mask"]] += r["n"]
    assert c["b", 1 | 8] == 1 and c["a", 1 | 8] == 2 and c["a", 1 | 8 | 16] == 1 and c["b", 1 | 8 | 16] == 2


def test_op13_counts_of_a_batch_go_back(spark):
    row = "key binary, mask int, part string, lab int, id long, n_least long, n long, none long"
    new = spark.createDataFrame([(bytearray(b"k"), 1, "a", 0, 3, 2, 5, 1)], row)
    state = spark.createDataFrame([(bytearray(b"k"), 1, "b", 2, 6, 1, 1, 0), (bytearray(b"k"), 1, "b", 0, 9, 1, 1, 0)], row)
    got = {(r["part"], r["mask"], r["lab"]): r["n"] for r in audit.counter_changes(audit.changes(new, state)).collect()}
    assert got == {("a", 1, 0): 3, ("a", 17, 0): 3, ("b", 1, 2): -1, ("b", 17, 2): 1}


def test_op13_tables(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    labels = spark.read.parquet(f"{sf_small}/labels.parquet").collect()
    got = found(audit.op13_filter_audit(spark, f"{sf_small}/documents.parquet", f"{sf_small}/labels.parquet"))
    assert got == brute([(r["doc_id"], r["text"], r["source"]) for r in docs], [(r["doc_id"], r["quality"], r["toxic"]) for r in labels])
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none.parquet"))
    empty = audit.op13_filter_audit(spark, str(tmp_path / "none.parquet"), f"{sf_small}/labels.parquet")
    assert empty.count() == 0 and empty.columns == ["part", "filter_order", "step", *COLUMNS]
