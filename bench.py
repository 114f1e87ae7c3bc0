"""Time the headline jobs; prints one JSON line with the median of three warm runs of each.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores. Each job runs to
its sink: ranks and search results to the no-op sink, the index to parquet. Both
index jobs read the same dump; the layout of a graph and its rounds are timed apart.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankweave.operators.pages import extract_links, extract_pages
from rankweave.operators.rank import lay_out, order_ranks, rank_pages
from rankweave.operators.terms import posting_lists
from rankweave.plans import table_inputs as inputs
from rankweave.plans.jobs import build_index, link_rank, search
from rankweave.sources.index_table import open_index, read_index, write_index
from rankweave.sources.readers import read_pages
from rankweave.sources.writers import posting_list_lines

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.compress", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    dump = inputs.write_document_dump(spark, FOLDER)
    accounts = inputs.account_edges(spark, FOLDER)
    seconds: dict[str, float] = {}

    def timed(name: str, job: Callable[[], object]) -> None:
        """Median of ``REPEATS`` runs after one to warm up."""
        runs = []
        for _ in range(REPEATS + 1):
            start = time.perf_counter()
            job()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)

    def dump_index() -> DataFrame:
        return build_index(extract_pages(read_pages(spark, dump)))

    def store_ranks(path: str) -> None:
        rank_pages(extract_links(extract_pages(read_pages(spark, dump)))).write.parquet(path)

    def new(name: str) -> str:
        return inputs.fresh_path(spark, name)

    graph = lay_out(accounts)
    timed("lay_out", lambda: lay_out(accounts))
    for rounds in (2, 5, 10):
        timed(f"rounds_k{rounds}", lambda: drain(order_ranks(rank_pages(graph, iterations=rounds))))
    timed("link_rank_k2", lambda: drain(link_rank(accounts)))
    timed("link_rank_dump", lambda: store_ranks(new("ranks")))
    timed("index_count", lambda: drain(dump_index()))
    timed("index_dump", lambda: write_index(dump_index(), new("index")))

    index_path, ranks_path = new("index"), new("ranks")
    write_index(dump_index(), index_path)
    store_ranks(ranks_path)

    def stored_search(terms: str) -> Callable[[], None]:
        return lambda: drain(search(terms, open_index(spark, index_path, terms), spark.read.parquet(ranks_path)))

    timed("posting_lists", lambda: drain(posting_list_lines(posting_lists(read_index(spark, index_path)))))
    timed("search_1_term", stored_search("the"))
    timed("search_5_terms", stored_search("the and with de la"))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
