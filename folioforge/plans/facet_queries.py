"""Searches through the inverted index of facets, beside the SQL of the scans that they replace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import gold
from folioforge.operators.facets import FacetIndex, build_facet_index
from folioforge.plans.gold_queries import _told, ALL, DISCOVERY
from folioforge.plans.registry import RAW, query
from folioforge.plans.single_queries import FACETS
from folioforge.sources.scratch import new_folder


def indexed(t):
    spark = t["works"].sparkSession
    folder = new_folder(spark, "facets")
    build_facet_index(gold.research_discovery(t), folder, 400)
    return FacetIndex(spark, folder)


@query("c2_search_by_index", *ALL, sql=RAW["c2_search_research"])
def c2_index(t):
    return _told(indexed(t).search(publisher_id="P3", language="en", year_from=1996, year_to=2000, topic_id="TBrand#12", after="W1"))


PAGES = " UNION ALL ".join(f"(SELECT '{name}' AS facet, work_id, title FROM discovery WHERE {where} AND work_id > 'W3' ORDER BY work_id LIMIT 51)" for name, (_, where) in FACETS.items())


@query("f6_pages_by_index", *ALL, sql=DISCOVERY + " " + PAGES)
def f6_index(t):
    """A page after a cursor for each of the eight facets, from one index."""
    index = indexed(t)
    pages = [index.search(after="W3", **facet).select(F.lit(name).alias("facet"), "work_id", "title") for name, (facet, _) in FACETS.items()]
    return reduce(DataFrame.unionByName, pages)
