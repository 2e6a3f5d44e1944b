import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from made_texts import edge_documents, prose

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


@pytest.fixture(scope="session")
def write(tmp_path_factory):
    """Writes documents (id, text, or with lang), benchmark items and embeddings as tables and returns the folder."""

    def put(documents, benchmark=(), extra=None, embeddings=()):
        folder = tmp_path_factory.mktemp("tables")
        rows = [(d[0], d[1], d[2] if len(d) > 2 else "en", "src", None if d[1] is None else len(d[1])) for d in documents]
        table = pa.Table.from_pylist([dict(zip(DOCS.names, r, strict=True)) for r in rows], DOCS)
        for name, kind in (extra or {}).items():
            table = table.append_column(name, pa.nulls(len(rows), kind))
        pq.write_table(table, folder / "documents.parquet")
        items = pa.Table.from_pylist([{"item_id": i, "text": t} for i, t in benchmark], pa.schema([("item_id", pa.int64()), ("text", pa.string())]))
        pq.write_table(items, folder / "benchmark.parquet")
        vectors = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
        pq.write_table(pa.Table.from_pylist([{"vec_id": i, "embedding": v, "label": 0} for i, v in embeddings], vectors), folder / "embeddings.parquet")
        return str(folder)

    return put


@pytest.fixture(scope="session")
def edges(write):
    clash = {n: pa.int64() for n in ("n_words", "fingerprint", "component_id", "fm_words", "lang_pred", "at", "twin", "had", "near_fp", "kinds", "kept", "key")}
    return write(edge_documents(), [(1, " ".join(edge_documents()[0][1].split()[10:30])), (2, "one"), (3, None), (4, "!!"), (None, prose(5, 300)[:200])], clash)


@pytest.fixture(scope="session")
def nothing(write):
    return write([], [])
