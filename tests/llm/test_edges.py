"""Every query of the subpackage over empty tables, and over tables with nulls in any column, very long and blank texts,
repeated rows, and extra columns with clashing names."""

import glob
import os

import pandas as pd
import pyarrow.parquet as pq
import pytest

from tessera.llm.queries import QUERIES

GROWING = {"documents": "doc_id", "corpus_rows": "row_id", "incoming_rows": "row_id", "ocr_pages": "page_id", "instructions": "pair_id"}
EXTRA = ("id", "n", "seq", "key", "a", "b", "word", "words", "form", "own", "tokens", "batch", "rep", "edges", "kind", "tags", "label", "pages")


@pytest.fixture(scope="module")
def folders(tmp_path_factory, data):
    root = tmp_path_factory.mktemp("edges")
    for case in ("empty", "nasty"):
        os.makedirs(f"{root}/{case}")
        for f in glob.glob(f"{data}/*.parquet"):
            name = os.path.basename(f)[:-8]
            t = pq.read_table(f)
            if name in GROWING:
                t = t.slice(0, 0) if case == "empty" else nasty(t, GROWING[name])
            pq.write_table(t, f"{root}/{case}/{name}.parquet")
    return root


def nasty(t, key):
    import pyarrow as pa

    df = t.slice(0, 24).to_pandas(types_mapper=None)
    rows = df.copy()
    texts = ["", " ", "\n\n", "​", "...", "a", "।", "x" * 120_000, "word " * 30_000, "\n".join(["line"] * 5000)]
    for c in ("text", "output", "instruction", "input"):
        if c in rows:
            rows.loc[rows.index[: len(texts)], c] = texts
    nulls = df.head(6).copy()
    for c in nulls.columns:
        if c != key:
            nulls[c] = None
    again = df.tail(6).copy()
    nulls[key] = range(10**12, 10**12 + len(nulls))
    again[key] = range(2 * 10**12, 2 * 10**12 + len(again))
    out = pd.concat([rows, nulls, again, again.assign(**{key: range(3 * 10**12, 3 * 10**12 + len(again))})], ignore_index=True)
    table = pa.Table.from_pandas(out, schema=t.schema, preserve_index=False)
    for c in EXTRA:
        if c not in table.column_names:
            table = table.append_column(c, pa.array(["clash"] * len(table)))
    return table


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, folders, name):
    got = QUERIES[name](spark, f"{folders}/empty")
    rows = got.collect()
    if name.endswith("_found"):
        assert rows == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nasty(spark, folders, name):
    got = QUERIES[name](spark, f"{folders}/nasty")
    names = got.columns
    assert len(names) == len(set(names))
    rows = got.collect()
    if name == "p5_found":
        assert len(rows) == len({r[0] for r in rows})
