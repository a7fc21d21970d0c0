"""From raw nested work records to the fifteen canonical tables.

Records are parsed once; each table is a projection of the parsed DataFrame. Empty arrays give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import scalars as S

SOURCE = "struct<id:string,display_name:string,type:string,issn_l:string,host_organization:string,host_organization_name:string>"
LOCATION = f"struct<source:{SOURCE},is_oa:boolean,landing_page_url:string,pdf_url:string,license:string,version:string>"
RECORD = f"""id string, doi string, title string, display_name string, type string, language string, publication_year long, publication_date string, created_date string, updated_date string,
cited_by_count long, referenced_works_count long, open_access struct<is_oa:boolean,oa_status:string>, primary_location {LOCATION}, locations array<{LOCATION}>,
authorships array<struct<author:struct<id:string,display_name:string,orcid:string>,author_position:string,is_corresponding:boolean,raw_author_name:string,institutions:array<struct<id:string,display_name:string,ror:string,country_code:string,type:string>>>>,
topics array<struct<id:string,display_name:string,score:double>>, keywords array<struct<id:string,display_name:string,score:double>>,
mesh array<struct<descriptor_ui:string,descriptor_name:string,qualifier_ui:string,qualifier_name:string,is_major_topic:boolean>>,
referenced_works array<string>, grants array<struct<funder:string,funder_display_name:string,award_id:string>>"""  # fmt: skip
ARRAYS = ("authorships", "topics", "keywords", "mesh", "referenced_works", "locations", "grants")
INTEGERS = ("publication_year", "cited_by_count", "referenced_works_count")
#: Columns that parsing adds or needs; tables do not carry them.
PARSED = ("raw", "r", "v", "keys")
DATES = ("publication_date", "created_date", "updated_date")
TEXTS = ("title", "display_name", "type", "language")


def parse_works(raw: DataFrame) -> DataFrame:
    """Add r (typed record), v (variant, for type tests) and keys (of the record) to rows (raw, ...); work_id is NULL where it is malformed."""
    record = F.from_json(F.col("raw"), RECORD)
    return raw.withColumns({"r": record, "v": F.try_parse_json("raw"), "keys": F.json_object_keys("raw")}).withColumn("work_id", S.normalize_id(F.col("r.id"), "W"))


def kind(path: str) -> Column:
    """JSON type at a path: NULL if absent, VOID for null."""
    return F.schema_of_variant(F.try_variant_get("v", f"$.{path}", "variant"))


def presence(key: str) -> Column:
    """MISSING, NULL, EMPTY or PRESENT; NULL for a value that is no array."""
    here = F.array_contains("keys", key)
    k = kind(key)
    return (
        F.when(~here, "MISSING").when(k == "VOID", "NULL").when(~F.startswith(k, F.lit("ARRAY")), F.lit(None)).when(F.size(F.try_variant_get("v", f"$.{key}", "array<variant>")) == 0, "EMPTY").otherwise("PRESENT")
    )


def _opened(df: DataFrame, columns: list[str], array: Column, at: str, item: str) -> DataFrame:
    """One row for each item of array, as posexplode gives them; that one's own filter on the array's size would parse each record once more."""
    return df.select(*columns, F.posexplode_outer(array).alias(at, item)).where(F.col(at).isNotNull())


def _items(p: DataFrame, array: str, at: str) -> DataFrame:
    return _opened(p, [c for c in p.columns if c not in PARSED], F.col(f"r.{array}"), at, "x")


def _first(df: DataFrame, keys: list[str], at: str, columns: list[str]) -> DataFrame:
    """First occurrence of each key, by place."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.col(at)).alias("m")).select(*keys, "m.*")


def _any(array: str, bad) -> Column:
    """True if an element is bad (a test that is NULL is not)."""
    return F.coalesce(F.exists(array, lambda x: F.coalesce(bad(x), F.lit(False))), F.lit(False))


def record_errors() -> Column:
    """Array of the rules that a parsed record breaks; empty for a record that maps."""
    text = lambda c: F.col(f"r.{c}")
    source = lambda s: s.isNotNull() & (S.bad_id(s["id"], "S", True) | S.malformed(s["issn_l"], S.normalize_issn(s["issn_l"])) | S.bad_id(s["host_organization"], "P"))
    rules = {
        "record": F.col("v").isNull() | ~F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")),
        "id": F.col("work_id").isNull(),
        "doi": S.malformed(text("doi"), S.normalize_doi(text("doi"))),
        **{c: text(c).isNotNull() & S.strict_date(text(c)).isNull() for c in DATES},
        **{c: ~kind(c).isin("BIGINT", "VOID") for c in INTEGERS},
        **{c: ~kind(c).isin("STRING", "VOID") for c in TEXTS},
        "open_access.is_oa": ~kind("open_access.is_oa").isin("BOOLEAN", "VOID"),
        **{c: presence(c).isNull() for c in ARRAYS},
        "primary_location": source(F.col("r.primary_location.source")),
        "author": _any("r.authorships", lambda a: S.bad_present_id(a["author"]["id"], "A") | S.malformed(a["author"]["orcid"], S.normalize_orcid(a["author"]["orcid"]))),
        "institution": _any("r.authorships", lambda a: F.exists(a["institutions"], lambda i: S.bad_present_id(i["id"], "I") | S.malformed(i["ror"], S.normalize_ror(i["ror"])))),
        "topic": _any("r.topics", lambda x: S.bad_id(x["id"], "T", True)),
        "keyword": _any("r.keywords", lambda x: x["id"].isNull() | S.normalize_keyword(x["id"]).isNull()),
        "mesh": _any("r.mesh", lambda x: S.optional_text(x["descriptor_ui"]).isNull()),
        "location": _any("r.locations", lambda x: source(x["source"])),
        "grant": _any("r.grants", lambda x: S.bad_present_id(x["funder"], "F")),
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]))


def relaxed(raw: DataFrame) -> DataFrame:
    """For a diagnosis: timestamps cut to dates and hosts that are no publishers nulled, then map again."""
    dates = raw
    for c in DATES:
        dates = dates.withColumn("raw", F.regexp_replace("raw", rf'("{c}"\s*:\s*"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})T[^"]*"', '$1"'))
    return dates.withColumn("raw", F.regexp_replace("raw", rf'("host_organization"\s*:\s*)"(?!{S.ID_PREFIX}P[0-9]+")[^"]*"', "$1null"))


def split_errors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows that map, and rejects with their errors."""
    marked = parsed.withColumn("errors", record_errors())
    return marked.where(F.size("errors") == 0).drop("errors"), marked.where(F.size("errors") > 0)


def broken_rules(parsed: DataFrame) -> DataFrame:
    """(error): one row for each rule that a record breaks; the rules are evaluated once for each record."""
    return parsed.select(F.explode_outer(record_errors()).alias("error")).where("error IS NOT NULL")


def works(p: DataFrame) -> DataFrame:
    source = F.col("r.primary_location.source")
    return p.select(
        *_carried(p),
        "work_id",
        S.entity_url(F.col("work_id")).alias("work_id_url"),
        S.normalize_doi(F.col("r.doi")).alias("doi"),
        F.coalesce(S.optional_text(F.col("r.title")), S.optional_text(F.col("r.display_name"))).alias("title"),
        F.col("r.publication_year").cast("int").alias("publication_year"),
        S.strict_date(F.col("r.publication_date")).alias("publication_date"),
        S.optional_text(F.col("r.type")).alias("work_type"),
        S.optional_text(F.col("r.language")).alias("language"),
        "r.cited_by_count",
        "r.referenced_works_count",
        "r.open_access.is_oa",
        S.optional_text(F.col("r.open_access.oa_status")).alias("oa_status"),
        S.normalize_id(source["id"], "S").alias("primary_source_id"),
        S.normalize_id(source["host_organization"], "P").alias("primary_publisher_id"),
        S.strict_date(F.col("r.created_date")).alias("source_created_date"),
        S.strict_date(F.col("r.updated_date")).alias("source_updated_date"),
        *[presence(c).alias(f"{c}_presence") for c in ARRAYS],
    )


def _carried(p: DataFrame) -> list[str]:
    return [c for c in p.columns if c not in (*PARSED, "work_id")]


def work_authors(p: DataFrame) -> DataFrame:
    x = lambda c: F.col(f"x.{c}")
    return _items(p, "authorships", "authorship_index").select(*_carried(p), "work_id", "authorship_index", S.normalize_id(x("author.id"), "A").alias("author_id"), S.optional_text(x("author_position")).alias("author_position"), x("is_corresponding").alias("is_corresponding"), S.optional_text(x("raw_author_name")).alias("raw_author_name"))


def work_author_institutions(p: DataFrame) -> DataFrame:
    inner = _opened(_items(p, "authorships", "authorship_index"), [*_carried(p), "work_id", "authorship_index"], F.col("x.institutions"), "institution_index", "i")
    return inner.select(*_carried(p), "work_id", "authorship_index", "institution_index", S.normalize_id(F.col("i.id"), "I").alias("institution_id"))


def work_topics(p: DataFrame) -> DataFrame:
    rows = _items(p, "topics", "at").select(*_carried(p), "work_id", "at", S.normalize_id(F.col("x.id"), "T").alias("topic_id"), "x.score")
    return _first(rows, [*_carried(p), "work_id", "topic_id"], "at", ["score"])


def work_keywords(p: DataFrame) -> DataFrame:
    rows = _items(p, "keywords", "at").select(*_carried(p), "work_id", "at", S.normalize_keyword(F.col("x.id")).alias("keyword_id"), S.optional_text(F.col("x.display_name")).alias("display_name"), "x.score")
    return _first(rows, [*_carried(p), "work_id", "keyword_id"], "at", ["display_name", "score"])


def work_mesh(p: DataFrame) -> DataFrame:
    texts = [S.optional_text(F.col(f"x.{c}")).alias(c) for c in ("descriptor_ui", "descriptor_name", "qualifier_ui", "qualifier_name")]
    return _items(p, "mesh", "mesh_index").select(*_carried(p), "work_id", "mesh_index", *texts, "x.is_major_topic")


def work_references(p: DataFrame) -> DataFrame:
    target = S.normalize_id(F.col("x"), "W")
    status = F.when(S.optional_text(F.col("x")).isNull(), "MISSING").when(target.isNull(), "MALFORMED").otherwise("RESOLVED_ID")
    return _items(p, "referenced_works", "reference_index").select(*_carried(p), "work_id", "reference_index", target.alias("referenced_work_id"), F.col("x").alias("raw_reference"), status.alias("reference_status"))


def work_locations(p: DataFrame) -> DataFrame:
    """Locations, or one fallback row from the primary location; at most one is primary.

    A location is primary if its source is the primary source (no source matches no source) and its landing page is
    the primary one's; without a primary landing page only a single location can be.
    """
    primary = F.col("r.primary_location")
    listed = F.coalesce(F.size("r.locations") > 0, F.lit(False))
    rows = F.when(listed, F.col("r.locations")).when(primary.isNotNull(), F.array(primary))
    source, page = S.normalize_id(primary["source"]["id"], "S"), S.optional_text(primary["landing_page_url"])

    def fits(x: Column) -> Column:
        same_source = S.normalize_id(x["source"]["id"], "S").eqNullSafe(source)
        same_page = F.coalesce(S.optional_text(x["landing_page_url"]) == page, F.lit(False))
        return same_source & (same_page | (page.isNull() & (F.size("r.locations") == 1)))

    first = F.when(listed & primary.isNotNull(), F.array_position(F.transform("r.locations", fits), True) - 1).when(~listed, F.lit(0))
    out = p.withColumns({"_rows": rows, "_first": first, "_origin": F.when(listed, "LOCATIONS_ARRAY").otherwise("PRIMARY_LOCATION_FALLBACK")})
    out = _opened(out, [*_carried(p), "work_id", "_first", "_origin"], F.col("_rows"), "location_index", "x")
    texts = [S.optional_text(F.col(f"x.{c}")).alias(c) for c in ("landing_page_url", "pdf_url", "license", "version")]
    primary_here = F.coalesce(F.col("location_index") == F.col("_first"), F.lit(False))
    return out.select(*_carried(p), "work_id", "location_index", F.col("_origin").alias("location_origin"), S.normalize_id(F.col("x.source.id"), "S").alias("source_id"), "x.is_oa", *texts, primary_here.alias("is_primary"))


def work_grants(p: DataFrame) -> DataFrame:
    return _items(p, "grants", "grant_index").select(*_carried(p), "work_id", "grant_index", S.normalize_id(F.col("x.funder"), "F").alias("funder_id"), S.optional_text(F.col("x.award_id")).alias("award_id"), S.optional_text(F.col("x.funder_display_name")).alias("funder_display_name"))


def _sources(p: DataFrame) -> DataFrame:
    """Sources of a record in the order met: the primary location's, then the locations'."""
    met = F.concat(F.array(F.col("r.primary_location.source")), F.coalesce(F.transform("r.locations", lambda x: x["source"]), F.array().cast(f"array<{SOURCE}>")))
    return _opened(p, [*_carried(p), "work_id"], met, "at", "x").where("x IS NOT NULL")


def _entity(rows: DataFrame, p: DataFrame, key: str, columns: list[Column]) -> DataFrame:
    named = rows.select(*_carried(p), "work_id", "at", *columns).where(F.col(key).isNotNull())
    names = [c for c in named.columns if c not in (*_carried(p), "work_id", "at", key)]
    return _first(named, [*_carried(p), "work_id", key], "at", names)


def authors(p: DataFrame) -> DataFrame:
    a = lambda c: F.col(f"x.author.{c}")
    return _entity(_items(p, "authorships", "at"), p, "author_id", [S.normalize_id(a("id"), "A").alias("author_id"), S.optional_text(a("display_name")).alias("display_name"), S.normalize_orcid(a("orcid")).alias("orcid")])


def institutions(p: DataFrame) -> DataFrame:
    rows = _opened(_items(p, "authorships", "a"), [*_carried(p), "work_id", "a"], F.col("x.institutions"), "b", "x").withColumn("at", F.struct("a", "b"))
    i = lambda c: F.col(f"x.{c}")
    return _entity(rows, p, "institution_id", [S.normalize_id(i("id"), "I").alias("institution_id"), S.optional_text(i("display_name")).alias("display_name"), S.normalize_ror(i("ror")).alias("ror"), F.upper(S.optional_text(i("country_code"))).alias("country_code"), S.optional_text(i("type")).alias("institution_type")])


def sources(p: DataFrame) -> DataFrame:
    s = lambda c: F.col(f"x.{c}")
    return _entity(_sources(p), p, "source_id", [S.normalize_id(s("id"), "S").alias("source_id"), S.optional_text(s("display_name")).alias("display_name"), S.optional_text(s("type")).alias("source_type"), S.normalize_issn(s("issn_l")).alias("issn_l"), S.normalize_id(s("host_organization"), "P").alias("host_publisher_id")])


def publishers(p: DataFrame) -> DataFrame:
    return _entity(_sources(p), p, "publisher_id", [S.normalize_id(F.col("x.host_organization"), "P").alias("publisher_id"), S.optional_text(F.col("x.host_organization_name")).alias("display_name")])


def topics(p: DataFrame) -> DataFrame:
    return _entity(_items(p, "topics", "at"), p, "topic_id", [S.normalize_id(F.col("x.id"), "T").alias("topic_id"), S.optional_text(F.col("x.display_name")).alias("display_name")])


def funders(p: DataFrame) -> DataFrame:
    return _entity(_items(p, "grants", "at"), p, "funder_id", [S.normalize_id(F.col("x.funder"), "F").alias("funder_id"), S.optional_text(F.col("x.funder_display_name")).alias("display_name")])


TABLES = {f.__name__: f for f in (works, authors, institutions, sources, publishers, topics, funders, work_authors, work_author_institutions, work_topics, work_keywords, work_references, work_mesh, work_locations, work_grants)}


def map_all(parsed: DataFrame) -> dict[str, DataFrame]:
    """The fifteen tables of records that map; parse once and keep the parsed rows, as each table reads them."""
    return {name: table(parsed) for name, table in TABLES.items()}


def attach_lineage(df: DataFrame, assets: DataFrame, run_id: str, processed_at: Column) -> DataFrame:
    """The seven lineage columns from the asset row of each record; a payload column of such a name is an error."""
    columns = ["source_asset_id", "source_checksum_sha256", "lineage_source_updated_date", "run_id", "processed_at", "activity_state", "deleted_at"]
    clash = set(columns) & set(df.columns)
    if clash:
        raise ValueError(f"lineage columns in the payload: {', '.join(sorted(clash))}")
    facts = assets.select(F.col("asset_id").alias("source_asset_id"), F.col("checksum").alias("source_checksum_sha256"), F.col("updated_date").alias("lineage_source_updated_date"))
    joined = df.join(facts, df["asset"] == facts["source_asset_id"])
    return joined.withColumns({"run_id": F.lit(run_id), "processed_at": processed_at, "activity_state": F.lit("ACTIVE"), "deleted_at": F.lit(None).cast("timestamp")})


def compatibility(parsed: DataFrame) -> DataFrame:
    """(first_error, records): how many records map (NULL), and what stops the others first."""
    return parsed.select(F.get(record_errors(), F.lit(0)).alias("first_error")).groupBy("first_error").agg(F.count("*").alias("records"))


def unknown_keys(raw: DataFrame, catalog: list[str]) -> DataFrame:
    """(key, records) of top-level keys outside a catalog, and catalog keys that no record has (records 0)."""
    seen = raw.select(F.explode(F.array_distinct(F.json_object_keys("raw"))).alias("key")).groupBy("key").agg(F.count("*").alias("records"))
    known = raw.sparkSession.createDataFrame([(k,) for k in catalog], "key string")
    return seen.join(known, "key", "left_anti").unionByName(known.join(seen, "key", "left_anti").withColumn("records", F.lit(0).cast("long")))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
