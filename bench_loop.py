"""The same work in one process: a plain Python loop, or the query's SQL on one DuckDB thread.  For contrast with bench.py."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from foliant.functions import html as H  # noqa: E402
from foliant.functions import kernels as K  # noqa: E402
from foliant.functions import markup as M  # noqa: E402
from foliant.functions import postprocess as P  # noqa: E402
from foliant.operators import paging as G  # noqa: E402
from foliant.plans import registry, texts  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def rows(sql: str) -> list:
    return duckdb.sql(sql).fetchall()


def pages() -> list[str]:
    return [x for (x,) in rows(f"SELECT html FROM '{FOLDER}/pages.parquet'")]


def documents() -> list[str]:
    return [x for (x,) in rows(f"SELECT text FROM '{FOLDER}/documents.parquet'")]


LOOPS = {
    "html_to_markup": lambda: [H.to_markup(h) for h in pages()],
    "markup_lines": lambda: [M.parsed(H.to_markup(h)) for h in pages()],
    "split_pages": lambda: [G.split_markup(m, texts.plain_pages(m)) for m in map(H.to_markup, pages())],
    "postprocessed": lambda: [P.postprocessed(t) for t in documents()],
    "truncate_repetitions": lambda: [K.truncate_repetitions(t) for t in documents()],
}


def main() -> None:
    took = {}
    for name in HEADLINE:
        began = time.time()
        if name in LOOPS:
            LOOPS[name]()
        elif name in registry.ORACLES:
            con = duckdb.connect(config={"threads": 1})
            for t in "lineitem orders customer part supplier events documents embeddings pages benchmark labels conversations".split():
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
            con.execute(registry.ORACLES[name]).fetchall()
        else:
            continue
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "one process", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(FOLDER.rstrip("/"))}))


if __name__ == "__main__":
    main()
