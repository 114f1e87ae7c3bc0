"""Every operator as a query over the given tables. ``table_oracles`` has the same results as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions import markup
from rankweave.operators import lookup, pages, rank, terms
from rankweave.plans import table_inputs as inputs
from rankweave.plans.jobs import build_index, index_dump, link_rank, rank_dump, search, search_files, search_index
from rankweave.runtime import stored
from rankweave.sources import readers, writers
from rankweave.sources.index_table import open_index, read_index, write_index
from rankweave.sources.ranked_index import search_top_k as search_ranked
from rankweave.sources.ranked_index import write_ranked_index

FEW_TERMS = "the and"
MANY_TERMS = "The that's with de la und Jean-Louis"
SPLIT_AT = 20  # entries of a list in the queries about long lists


def _rounded(df: DataFrame, column: str) -> DataFrame:
    # Sums differ in the last digits with their order, so comparisons round. The exact
    # ranks of the document graph end at the eighth digit, where no tie can arise.
    return df.withColumn(column, F.round(column, 8))


def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(inputs.html_records(spark, folder), body="article").select("page")


def page_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(inputs.html_records(spark, folder), body="article")


def page_dump(spark: SparkSession, folder: str) -> DataFrame:
    raw = readers.read_pages(spark, inputs.write_document_dump(spark, folder))
    return pages.extract_pages(raw)


def page_dump_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Dump files that end at any byte of their last page."""
    raw = readers.read_pages(spark, inputs.write_cut_dumps(spark, folder))
    return pages.extract_pages(raw.select("value"))


def wiki_links(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_links(inputs.wiki_pages(spark, folder))


def link_pieces(spark: SparkSession, folder: str) -> DataFrame:
    text = inputs.wiki_pages(spark, folder)
    return text.select("page", F.explode(markup.link_matches(F.col("text"))).alias("link"))


def _edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    edges = inputs.account_edges(spark, folder)
    line = F.concat_ws("\t", "src", "dst")
    return edges.select(F.explode(F.array(line, F.concat(F.lit("# "), line))).alias("value"))


def edge_list_parse(spark: SparkSession, folder: str) -> DataFrame:
    return readers.parse_edge_list(_edge_lines(spark, folder))


def edge_list_file(spark: SparkSession, folder: str) -> DataFrame:
    path = inputs.fresh_path(spark, "edges")
    _edge_lines(spark, folder).write.text(path)
    return readers.read_edge_list(spark, path)


def out_degree(spark: SparkSession, folder: str) -> DataFrame:
    return rank.out_degree(inputs.account_edges(spark, folder))


def node_set(spark: SparkSession, folder: str) -> DataFrame:
    return rank.node_set(inputs.account_edges(spark, folder))


def adjacency_init(spark: SparkSession, folder: str) -> DataFrame:
    adjacency = rank.init_ranks(inputs.document_edges(spark, folder))
    return adjacency.withColumn("links", F.array_join("links", ","))


def _split_sizes(lists: DataFrame, key: str, entries: str) -> DataFrame:
    """Entries per key, whether it has several rows, and whether these have different parts."""
    return lists.groupBy(key).agg(
        F.sum(F.size(entries)).alias("entries"),
        (F.count("*") > 1).alias("split"),
        (F.count("*") == F.countDistinct("part")).alias("parts_differ"),
    )


def rank_state_file(spark: SparkSession, folder: str) -> DataFrame:
    path = inputs.fresh_path(spark, "state")
    writers.write_rank_state(rank.init_ranks(inputs.account_edges(spark, folder)), path)
    state = readers.read_rank_state(spark, path)
    return state.select("page", "rank", F.array_join("links", ",").alias("links"))


def rank_state_rounds(spark: SparkSession, folder: str) -> DataFrame:
    edges = inputs.account_edges(spark, folder)
    graph = rank.lay_out(edges)
    state = rank.rank_state(graph, rank.rank_pages(graph))
    return _rounded(state.withColumn("links", F.array_join("links", ",")), "rank")


def rank_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Three rounds in two runs over one graph, the second from the ranks of the first."""
    graph = rank.lay_out(inputs.account_edges(spark, folder))
    first = rank.rank_pages(graph, iterations=2)
    return _rounded(rank.rank_step(graph, first), "rank")


def link_contributions(spark: SparkSession, folder: str) -> DataFrame:
    edges = inputs.account_edges(spark, folder)
    start = rank.node_set(edges).withColumn("rank", F.lit(rank.INITIAL_RANK))
    return rank.contributions(rank.lay_out(edges), start)


def rank_step(spark: SparkSession, folder: str) -> DataFrame:
    edges = inputs.trade_edges(spark, folder)
    start = rank.node_set(edges).withColumn("rank", F.lit(rank.INITIAL_RANK))
    return _rounded(rank.rank_step(edges, start), "rank")


def rank_trade_2(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(rank.rank_pages(inputs.trade_edges(spark, folder), iterations=2), "rank")


def rank_trade_5(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(rank.rank_pages(inputs.trade_edges(spark, folder), iterations=5), "rank")


def rank_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(rank.rank_pages(inputs.account_edges(spark, folder), iterations=10), "rank")


def rank_damping(spark: SparkSession, folder: str) -> DataFrame:
    edges = inputs.account_edges(spark, folder)
    return _rounded(rank.rank_pages(edges, damping=0.5, iterations=3), "rank")


def rank_hubs(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of a graph whose hubs have most links."""
    return _rounded(rank.rank_pages(inputs.status_edges(spark, folder), iterations=3), "rank")


def rank_numbered(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks where many pages share the hash that numbers them, and each link by the names of its ends again."""
    graph = rank.lay_out(inputs.account_edges(spark, folder), bits=8)
    links = graph.named_links().groupBy(F.col("src").alias("page")).agg(F.sum("copies").alias("links"))
    return _rounded(rank.rank_pages(graph, iterations=3), "rank").join(links, "page", "left")


def adjacency_hubs(spark: SparkSession, folder: str) -> DataFrame:
    """Which link lists are split into several rows."""
    lists = rank.init_ranks(inputs.status_edges(spark, folder), max_list=SPLIT_AT)
    return _split_sizes(lists, "page", "links")


def adjacency_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Split link lists, and their links again."""
    return rank.adjacency_edges(rank.init_ranks(inputs.status_edges(spark, folder), max_list=SPLIT_AT))


def rank_links(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(link_rank(inputs.wiki_pages(spark, folder), iterations=3), "rank")


def rank_order(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(link_rank(inputs.document_edges(spark, folder)), "rank")


def rank_file(spark: SparkSession, folder: str) -> DataFrame:
    """Rank a dump into text files and read the ranks back."""
    path = inputs.fresh_path(spark, "ranks")
    rank_dump(spark, inputs.write_document_dump(spark, folder), path)
    return _rounded(readers.read_ranks(spark, path), "rank")


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return terms.tokenize(inputs.document_pages(spark, folder))


def tokens_by_line(spark: SparkSession, folder: str) -> DataFrame:
    return terms.tokenize(inputs.document_pages(spark, folder), delimiters=" '-\n\t")


def postings(spark: SparkSession, folder: str) -> DataFrame:
    return build_index(inputs.document_pages(spark, folder))


def posting_lists(spark: SparkSession, folder: str) -> DataFrame:
    index = stored(build_index(inputs.document_pages(spark, folder)), "postings")
    entries = F.transform("postings", lambda p: F.concat_ws(":", p["doc"], p["tf"]))
    return terms.posting_lists(index).select("term", "part", F.array_join(entries, " ").alias("postings"))


def posting_parse(spark: SparkSession, folder: str) -> DataFrame:
    index = stored(build_index(inputs.document_pages(spark, folder)), "postings")
    return readers.parse_posting_lists(writers.posting_list_lines(terms.posting_lists(index)))


def posting_file(spark: SparkSession, folder: str) -> DataFrame:
    path = inputs.fresh_path(spark, "lists")
    index = stored(build_index(inputs.document_pages(spark, folder)), "postings")
    writers.write_posting_lists(terms.posting_lists(index), path)
    return readers.read_posting_lists(spark, path)


def posting_split(spark: SparkSession, folder: str) -> DataFrame:
    """Which posting lists are split into several rows."""
    index = stored(build_index(inputs.document_pages(spark, folder)), "postings")
    return _split_sizes(terms.posting_lists(index, max_list=SPLIT_AT), "term", "postings")


def posting_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Split posting lists as lines, and their postings again."""
    index = stored(build_index(inputs.document_pages(spark, folder)), "postings")
    return readers.parse_posting_lists(writers.posting_list_lines(terms.posting_lists(index, max_list=SPLIT_AT)))


def posting_colon(spark: SparkSession, folder: str) -> DataFrame:
    """Posting lists of documents with colons in their names, through lines."""
    named = inputs.document_pages(spark, folder).withColumn("page", F.concat(F.lit("a:b:"), "page"))
    index = stored(build_index(named), "postings")
    return readers.parse_posting_lists(writers.posting_list_lines(terms.posting_lists(index)))


def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Rank, state, hit and posting lines of which every third has no number."""
    number = F.when(F.col("doc_id") % 3 == 0, "none").otherwise(F.col("doc_id").cast("string"))
    name = F.concat(F.lit("d"), "doc_id")
    docs = inputs.table(spark, folder, "documents")

    def lines(*columns):
        return docs.select(F.concat(*columns).alias("value"))

    tab = F.lit("\t")
    found = [
        readers.parse_ranks(lines(number, tab, name)).select("page", F.col("rank").alias("number"), F.lit("rank").alias("kind")),
        readers.parse_rank_state(lines(name, tab, number, tab)).select("page", F.col("rank").alias("number"), F.lit("state").alias("kind")),
        readers.parse_hits(lines(name, tab, number)).select("doc", F.col("tf").cast("double"), F.lit("hit").alias("kind")),
        readers.parse_posting_lists(lines(F.lit("t\t"), name, F.lit(":"), number)).select("doc", F.col("tf").cast("double"), F.lit("posting").alias("kind")),
    ]
    return found[0].union(found[1]).union(found[2]).union(found[3])


def wiki_rules(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_links(inputs.rule_pages(spark, folder))


def wiki_rules_dump(spark: SparkSession, folder: str) -> DataFrame:
    raw = readers.read_pages(spark, inputs.write_rule_dump(spark, folder))
    return pages.extract_links(pages.extract_pages(raw))


def page_rules(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(inputs.page_records(spark, folder))


def rank_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each page in ascending order of rank."""
    return rank.number_ranks(_rounded(rank.rank_pages(inputs.document_edges(spark, folder)), "rank"))


def rank_clamped(spark: SparkSession, folder: str) -> DataFrame:
    """Damping above 1 and below 0, and no rounds."""
    edges = inputs.trade_edges(spark, folder)
    high = rank.rank_pages(edges, damping=7).withColumn("setting", F.lit("high"))
    low = rank.rank_pages(edges, damping=-1).withColumn("setting", F.lit("low"))
    none = rank.rank_pages(edges, iterations=0).withColumn("setting", F.lit("none"))
    return _rounded(high.unionByName(low).unionByName(none), "rank")


def rank_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs into one folder: the ranks of the second are left."""
    path = inputs.fresh_path(spark, "ranks")
    dump = inputs.write_document_dump(spark, folder)
    rank_dump(spark, dump, path, iterations=1)
    rank_dump(spark, dump, path, iterations=3)
    return _rounded(readers.read_ranks(spark, path), "rank")


def search_stored(spark: SparkSession, folder: str) -> DataFrame:
    """All three jobs over one dump, through the stored index and rank files."""
    dump = inputs.write_document_dump(spark, folder)
    paths = [inputs.fresh_path(spark, name) for name in ("ranks", "index", "results")]
    rank_dump(spark, dump, paths[0])
    index_dump(spark, dump, paths[1])
    search_index(spark, FEW_TERMS, paths[1], paths[0], paths[2])
    parts = F.split("value", "\t", 2)
    found = spark.read.text(paths[2]).select(parts[0].alias("doc"), parts[1].cast("double").alias("score"))
    return _rounded(found, "score")


def index_dump_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Index a dump into the stored form and read it back."""
    path = inputs.fresh_path(spark, "index")
    index_dump(spark, inputs.write_document_dump(spark, folder), path)
    return read_index(spark, path).select("term", "doc", "tf")


def term_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.lookup_terms(postings(spark, folder), FEW_TERMS)


def term_lookup_stored(spark: SparkSession, folder: str) -> DataFrame:
    path = inputs.fresh_path(spark, "index")
    write_index(postings(spark, folder), path)
    return lookup.lookup_terms(read_index(spark, path), MANY_TERMS)


def term_lookup_list(spark: SparkSession, folder: str) -> DataFrame:
    """Every term of the benchmark items as a keyword, in the stored index."""
    path = inputs.fresh_path(spark, "index")
    write_index(postings(spark, folder), path)
    keywords = inputs.table(spark, folder, "benchmark").select("text")
    return lookup.lookup_terms(open_index(spark, path, keywords), keywords)


def doc_tf(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.sum_hits(term_lookup(spark, folder))


def hits_file(spark: SparkSession, folder: str) -> DataFrame:
    path = inputs.fresh_path(spark, "hits")
    writers.write_hits(doc_tf(spark, folder), path)
    return readers.read_hits(spark, path)


def _search(spark: SparkSession, folder: str, keywords: str) -> DataFrame:
    ranks = rank.rank_pages(inputs.document_edges(spark, folder))
    return search(keywords, postings(spark, folder), ranks)


def search_few(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_search(spark, folder, FEW_TERMS), "score")


def search_many(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_search(spark, folder, MANY_TERMS), "score")


def search_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best results, from the index with ranks."""
    path = inputs.fresh_path(spark, "index")
    ranks = _rounded(rank.rank_pages(inputs.document_edges(spark, folder)), "rank")
    write_ranked_index(postings(spark, folder), ranks, path, buckets=8)
    return search_ranked(spark, MANY_TERMS, path, 10)


def search_dump(spark: SparkSession, folder: str) -> DataFrame:
    """All three jobs over one dump, through the text files between them."""
    dump = inputs.write_document_dump(spark, folder)
    paths = [inputs.fresh_path(spark, name) for name in ("ranks", "lists", "results")]
    rank_dump(spark, dump, paths[0])
    index = stored(build_index(pages.extract_pages(readers.read_pages(spark, dump))), "postings")
    writers.write_posting_lists(terms.posting_lists(index), paths[1])
    search_files(spark, FEW_TERMS, paths[1], paths[0], paths[2])
    parts = F.split("value", "\t", 2)
    found = spark.read.text(paths[2]).select(parts[0].alias("doc"), parts[1].cast("double").alias("score"))
    return _rounded(found, "score")


QUERIES = {
    query.__name__: query
    for query in [
        page_titles,
        page_bodies,
        page_dump,
        page_dump_cut,
        link_pieces,
        wiki_links,
        edge_list_parse,
        edge_list_file,
        out_degree,
        node_set,
        adjacency_init,
        rank_state_file,
        link_contributions,
        rank_step,
        rank_trade_2,
        rank_trade_5,
        rank_accounts,
        rank_damping,
        rank_state_rounds,
        rank_resume,
        rank_hubs,
        rank_numbered,
        adjacency_hubs,
        adjacency_parts,
        rank_rows,
        rank_clamped,
        rank_replaced,
        wiki_rules,
        wiki_rules_dump,
        page_rules,
        rank_links,
        rank_order,
        rank_file,
        tokens,
        tokens_by_line,
        postings,
        posting_lists,
        posting_parse,
        posting_split,
        posting_parts,
        posting_colon,
        malformed_lines,
        posting_file,
        index_dump_stored,
        term_lookup,
        term_lookup_stored,
        term_lookup_list,
        doc_tf,
        hits_file,
        search_few,
        search_many,
        search_top_k,
        search_dump,
        search_stored,
    ]
}
