"""Batches added one after another lose what one brute force over all of them removes."""

import hashlib
import threading

from made_texts import edge_documents, prose

from scrollwork.llm import history, substrings
from scrollwork.llm.common import table


def test_batches_are_held_against_all_before(spark, write, tmp_path):
    shared = prose(1, 90).split()
    docs = [(k, prose(k + 10, k % 30) + " " + " ".join(shared[k % 9 : 60 + k % 20]) + "\n" + prose(k + 50, 25, 30)) for k in range(40)] + [(40, "w " * 200), (41, "w " * 90), (42, None), (43, " ")]
    want = substrings.brute_force(docs)
    index = history.WindowHistory(spark, str(tmp_path / "runs"))
    sizes = []
    for lo, hi in ((0, 20), (20, 23), (23, 24), (24, 41), (41, 44)):
        got = index.add(table(spark, write(docs[lo:hi]), "documents")).collect()
        sizes.append(len(index.runs()))
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"]).hexdigest()) for r in got} == {d: want[d] for d, _ in docs[lo:hi]}
    assert max(sizes) <= 3 and index.runs()[0][0] == 0 and index.runs()[-1][1] == 4
    # what is added again goes as a whole, after a full compaction too
    index.compact(everything=True)
    assert index.runs() == [(0, 4)]
    again = {r["doc_id"]: r for r in index.add(table(spark, write(docs[:20]), "documents")).collect()}
    assert all(again[d]["n_removed"] == again[d]["n_words"] for d, _ in docs[:20] if again[d]["n_words"] >= 20)


def test_a_run_left_behind_does_no_harm(spark, write, tmp_path):
    index = history.WindowHistory(spark, str(tmp_path / "runs"))
    assert index.runs() == []
    rows = len(edge_documents())
    assert index.add(table(spark, write(edge_documents()), "documents")).count() == rows
    index._write(index._read((0, 0)), (0, 3))  # as after a compaction that ended before the old runs were deleted
    (tmp_path / "runs" / "run-00000004-00000004").mkdir()  # a run that was never finished
    assert index.runs() == [(0, 3)]
    assert index.add(table(spark, write([]), "documents")).count() == 0


def test_of_two_writers_none_loses_a_batch(spark, write, tmp_path):
    """Both look at the runs before either has written; the slower one is then held against the faster one's windows."""
    shared = prose(7, 60)
    docs = [(k, f"{shared} {prose(100 + k, 30)}") for k in range(6)]
    tables = [table(spark, write(docs[:3]), "documents"), table(spark, write(docs[3:]), "documents")]
    gate, looked, got = threading.Barrier(2), set(), {}

    class Slow(history.WindowHistory):
        def runs(self):
            found = super().runs()
            if threading.current_thread().name not in looked:
                looked.add(threading.current_thread().name)
                gate.wait(60)
            return found

    def add(k):
        got[k] = {r["doc_id"]: r["n_removed"] for r in Slow(spark, str(tmp_path / "runs")).add(tables[k]).collect()}

    threads = [threading.Thread(target=add, args=(k,), name=str(k)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    index = history.WindowHistory(spark, str(tmp_path / "runs"))
    assert index.runs()[-1][1] == 1
    first = 0 if got[0][0] == 0 else 1
    assert [n for _, n in sorted(got[first].items())] == [0, 60, 60] and [n for _, n in sorted(got[1 - first].items())] == [60, 60, 60]
