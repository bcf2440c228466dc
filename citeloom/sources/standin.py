"""Canonical tables from the relational test tables, which hold no scholarly data.

paper: documents (text) or orders (relational); scholar: customer; institution:
nation, in region; venue: supplier; patent: part; project: events; citations:
the parts of an order, by line number and part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class StandIn:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def text_papers(self) -> DataFrame:
        d = self.raw("documents")
        return d.select(F.col("doc_id").alias("paper_id"), F.col("text").alias("title"), F.col("source").alias("venue_name"), F.col("source").alias("venue_id"), F.col("n_chars").alias("n_citation"), "lang")

    def sci_papers(self) -> DataFrame:
        good = self.raw("labels").where("quality = 1").select(F.col("doc_id").alias("paper_id"))
        return self.text_papers().join(good, "paper_id", "left_semi").withColumn("is_sci", F.lit(True))

    def papers(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(F.col("o_orderkey").alias("paper_id"), F.col("o_orderpriority").alias("title"), F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_totalprice").alias("n_citation"), F.col("o_custkey").alias("person_id"))

    def keyword_papers(self) -> DataFrame:
        """Papers with the word of their status as the only keyword."""
        word = F.element_at(F.create_map(*[F.lit(x) for x in ("O", "open", "F", "filled", "P", "partial")]), F.col("o_orderstatus"))
        status = self.raw("orders").select(F.col("o_orderkey").alias("paper_id"), F.array(word).alias("keywords"))
        return self.papers().join(status, "paper_id")

    def authored_papers(self) -> DataFrame:
        s = self.scholars()
        author = F.struct(F.col("person_id").alias("author_id"), F.col("name"), F.col("org"), F.col("org_id"))
        return self.papers().join(s.select("person_id", "name", "org", "org_id"), "person_id").withColumn("authors", F.array(author))

    def scholars(self) -> DataFrame:
        n = self.raw("nation").select(F.col("n_nationkey").alias("org_id"), F.col("n_name").alias("org"), F.col("n_regionkey").alias("region_id"))
        c = self.raw("customer").select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("org_id"), F.col("c_acctbal").alias("n_citation"), F.col("c_mktsegment").alias("domain"))
        return c.join(n, "org_id")

    def figures(self) -> DataFrame:
        return self.raw("events").select(F.col("user_id").alias("person_id"), F.col("event_type").alias("interest")).distinct()

    def scholar_paper(self) -> DataFrame:
        return self.papers().select("person_id", "paper_id", "title", "n_citation")

    def scholar_patent(self) -> DataFrame:
        lines = self.raw("lineitem").select(F.col("l_orderkey").alias("paper_id"), F.col("l_partkey").alias("patent_id"))
        owners = self.raw("orders").select(F.col("o_orderkey").alias("paper_id"), F.col("o_custkey").alias("person_id"))
        return lines.join(owners, "paper_id").select("person_id", "patent_id")

    def projects(self) -> DataFrame:
        return self.raw("events").select(F.col("event_id").alias("project_id"), F.col("user_id").alias("person_id"), F.col("event_type").alias("titles"), F.col("value").alias("fund_amount"), F.date_format("ts", "yyyy-MM-dd").alias("start_date"))

    def orgs(self) -> DataFrame:
        r = self.raw("region").select(F.col("r_regionkey").alias("parent_org_id"), F.col("r_name").alias("parent_name"))
        n = self.raw("nation").select(F.col("n_nationkey").alias("org_id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("parent_org_id"))
        return n.join(r, "parent_org_id")

    def aliases(self) -> DataFrame:
        from citeloom.functions.text import normalised_name

        name = F.replace("name", F.lit("_"), F.lit(" "))
        return self.orgs().select(normalised_name(name).alias("alias_norm"), F.col("parent_org_id").alias("primary_id"), F.col("parent_name").alias("primary_name"), F.col("org_id").alias("secondary_id"), F.col("name").alias("secondary_name"))

    def venues(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("venue_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("org_id"), F.col("s_acctbal").alias("n_citation"))

    def venue_paper(self) -> DataFrame:
        return self.raw("lineitem").select(F.col("l_suppkey").alias("venue_id"), F.col("l_orderkey").alias("paper_id"), F.year("l_shipdate").alias("year"))

    def org_patent(self) -> DataFrame:
        v = self.venues().select("venue_id", "org_id")
        lines = self.raw("lineitem").select(F.col("l_suppkey").alias("venue_id"), F.col("l_partkey").alias("patent_id"))
        return lines.join(v, "venue_id").select("org_id", "patent_id")

    def patents(self) -> DataFrame:
        p = self.raw("part")
        return p.select(F.col("p_partkey").alias("patent_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("assignee"), F.col("p_type").alias("pub_kind"), F.col("p_size").alias("sequence"), F.col("p_retailprice").alias("price"))

    def edges(self, papers: DataFrame) -> DataFrame:
        """Flat citations of some papers, whose lines alone are numbered."""
        lines = self.raw("lineitem").select(F.col("l_orderkey").alias("paper_id"), "l_linenumber", F.col("l_partkey").alias("id"))
        mine = lines.join(F.broadcast(papers.select("paper_id").distinct()), "paper_id", "left_semi")
        order = Window.partitionBy("paper_id").orderBy("l_linenumber", "id")
        return mine.select("paper_id", (F.row_number().over(order) - 1).alias("pos"), F.col("id").cast("string").alias("cited_id"))

    def citations(self) -> DataFrame:
        """Ordered parts of each order as a nested list."""
        line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("id"))
        cited = F.transform(F.sort_array(F.collect_list(line)), lambda c: F.struct(c["id"].alias("id")))
        return self.raw("lineitem").groupBy(F.col("l_orderkey").alias("paper_id")).agg(cited.alias("cited"))
