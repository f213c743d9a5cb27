"""Sources other than parquet: text tables, nested JSON, file listings, tables inside HTML."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import cut

#: Texts that a string-typed merge reads as missing.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
PAGE_COUNTS = "map<string,map<string,struct<file:string,pages:int,full_path:string>>>"
LARGE_REPORTS = "map<string,array<struct<annee:string,pages:int,fichier:string>>>"


def read_table(spark: SparkSession, path: str, sep: str = ";", **options: str) -> DataFrame:
    """CSV with header, every cell a string, without byte-order mark, names trimmed; rows of blank cells are dropped."""
    df = spark.read.options(header=True, sep=sep, quote='"', escape='"', encoding="UTF-8", multiLine=True, **options).csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    filled = F.lit(False)
    for c in df.columns:
        filled = filled | (F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")) != "")
    return df.where(filled)


def to_numbers(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every column but the keys as double; what is no number becomes null, suffixes of number types included."""
    plain = lambda c: F.when(F.trim(c).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), F.trim(c).try_cast("double"))
    return df.select(*[F.col(f"`{c}`") if c in keys else plain(F.col(f"`{c}`")).alias(c) for c in df.columns])


def missing_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(F.col(f"`{c}`").isin(MISSING), None).otherwise(F.col(f"`{c}`")).alias(c) if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes])


def read_page_counts(spark: SparkSession, path: str) -> DataFrame:
    """(entreprise, annee, fichier, pages, chemin) of the nested counts; -1 pages mean unknown."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", PAGE_COUNTS)).alias("entreprise", "annees"))
    each = whole.select("entreprise", F.explode("annees").alias("annee", "r"))
    return each.select("entreprise", F.col("annee").try_cast("int").alias("annee"), F.col("r.file").alias("fichier"), F.when(F.col("r.pages") >= 0, F.col("r.pages")).alias("pages"), F.col("r.full_path").alias("chemin"))


def read_large_list(spark: SparkSession, path: str) -> DataFrame:
    """(entreprise, annee, pages, fichier) of the list of large reports, with or without its frame."""
    text = spark.read.text(path, wholetext=True)
    framed = F.from_json("value", f"struct<rapports_volumineux:{LARGE_REPORTS}>")["rapports_volumineux"]
    bare = F.from_json("value", LARGE_REPORTS)
    return text.select(F.explode(F.coalesce(framed, bare)).alias("entreprise", "liste")).select("entreprise", F.inline("liste")).withColumn("annee", F.col("annee").try_cast("int"))


BLOCK = "type string, text string, table_body string, table_caption string, table_footnote string, img_path string, page_idx int"


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(fichier, bloc, ...) of layout files; a caption may be a text or a list; a root that is no list has no blocks."""
    whole = spark.read.text(path, wholetext=True).withColumn("fichier", F.col("_metadata.file_path")).where(F.trim("value").startswith("["))
    each = whole.select("fichier", F.posexplode(F.from_json("value", f"array<struct<{BLOCK.replace(' ', ':').replace(',:', ',')}>>")).alias("bloc", "b"))
    joined = lambda c: F.coalesce(F.array_join(F.from_json(c, "array<string>"), " "), c)
    return each.select("fichier", "bloc", "b.*").withColumns({c: joined(F.col(c)) for c in ("table_caption", "table_footnote")})


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(chemin, dossier, nom, annee, octets, modifie_le): files below a folder, as a table; content is not read. A name that
    is no year from 1990 to 2100 has none."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(folder).select("path", "length", "modificationTime")
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return files.select(
        F.col("path").alias("chemin"), F.element_at(parts, -2).alias("dossier"), name.alias("nom"), F.when(F.regexp_extract(name, r"^(\d{4})\.", 1).try_cast("int").between(1990, 2100), F.regexp_extract(name, r"^(\d{4})\.", 1).try_cast("int")).alias("annee"),
        F.col("length").alias("octets"), F.col("modificationTime").alias("modifie_le"),
    )


def preferred_file(files: DataFrame, keys: list[str], wanted: Column) -> DataFrame:
    """Of each key's files one whose name is the wanted one, case aside, else the first by path."""
    rank = F.struct((F.lower("nom") != F.lower(wanted)).alias("autre"), "chemin")
    return files.groupBy(*keys).agg(F.min_by("chemin", rank).alias("chemin"))


def latest_file(files: DataFrame, keys: list[str]) -> DataFrame:
    return files.groupBy(*keys).agg(F.max_by("chemin", F.struct("modifie_le", "chemin")).alias("chemin"))


def pdf_links(html: Column, base: str) -> Column:
    """Array of (url, titre) of links to PDF files; relative ones get ``base``; links without title are left out."""
    pattern = r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']+?\.pdf)(?:[?#][^\"']*)?[\"'][^>]*>(.*?)</a>"
    urls, titles = (F.regexp_extract_all(html, F.lit(pattern), F.lit(i)) for i in (1, 2))
    pairs = F.arrays_zip(urls.alias("u"), titles.alias("t"))
    clean = F.transform(pairs, lambda p: F.struct(
        F.when(p["u"].rlike(r"^https?://"), p["u"]).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(p["u"], "^/+", ""))).alias("url"),
        F.trim(F.regexp_replace(F.regexp_replace(p["t"], r"<[^>]+>", " "), r"\s+", " ")).alias("titre"),
    ))
    return F.filter(clean, lambda p: p["titre"] != "")


def table_rows(html: Column) -> Column:
    """Array of rows, each an array of cell texts, of the tables in a page; spans are not carried."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(cells(r), lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"\s+", " "))))


def statement_rows(html: Column, base: str) -> Column:
    """Array of (annee, genre, url) of the table of statements in a page, null where its header names no year.

    The year is that of the first cell, else the first of the whole row; the link is that of the last cell; rows without
    year or link are left out.
    """
    raw = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"\s+", " "))
    year = lambda t: F.nullif(F.regexp_extract(t, r"((?:19|20)\d{2})", 1), F.lit("")).cast("int")

    def read(row: Column) -> Column:
        parts = cells(row)
        first, last = F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1)
        return F.struct(F.coalesce(year(bare(first)), year(bare(row))).alias("annee"), bare(F.get(parts, F.lit(1))).alias("genre"), F.get(pdf_links(last, base), F.lit(0))["url"].alias("url"))

    header = bare(F.get(raw, F.lit(0)))
    rows = F.filter(F.transform(F.slice(raw, 2, F.greatest(F.size(raw) - 1, F.lit(0))), read), lambda r: r["annee"].isNotNull() & r["url"].isNotNull())
    return F.when(header.rlike(r"(?i)ann[ée]e|year"), rows)


def next_page(html: Column) -> Column:
    """Address of the page that follows, by its ``rel``, null if none."""
    tag = F.regexp_extract(html, r"(?is)<(?:a|link)\b[^>]*\brel\s*=\s*[\"']next[\"'][^>]*>", 0)
    return F.nullif(F.regexp_extract(tag, r"(?is)href\s*=\s*[\"']([^\"']+)", 1), F.lit(""))


def follow_pages(pages: DataFrame, first: DataFrame, most: int = 1000) -> DataFrame:
    """(depart, url, pas, html): pages (url, html) reached from each ``first`` (url) by following the next page, every page
    once. A step is one join; beyond ``most`` steps it is an error."""
    held = pages.select("url", "html", next_page(F.col("html")).alias("suite"))
    step = first.select(F.col("url").alias("depart"), "url").distinct().join(held, "url").withColumn("pas", F.lit(0))
    seen = step = cut(step)
    for i in range(1, most + 1):
        ahead = step.where("suite is not null").select("depart", F.col("suite").alias("url")).join(seen.select("depart", "url"), ["depart", "url"], "left_anti")
        step = cut(ahead.join(held, "url").withColumn("pas", F.lit(i)))
        if step.isEmpty():
            return seen.select("depart", "url", "pas", "html")
        seen = cut(seen.unionByName(step))
    raise ValueError(f"more than {most} pages in a row")


def jobs_of(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs (keys, chemin) found in either of two layouts of folders; the new layout counts where a job has both."""
    both = new.select(*keys, F.struct(F.lit(0).alias("ordre"), "chemin").alias("c")).unionByName(old.select(*keys, F.struct(F.lit(1).alias("ordre"), "chemin").alias("c")))
    return both.groupBy(*keys).agg(F.min("c").alias("c")).select(*keys, "c.chemin", F.when(F.col("c.ordre") == 0, "nouveau").otherwise("ancien").alias("disposition"))


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The table kept at ``path``; built and kept there where it does not exist, or by force."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if force or not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def expand_grid(html: str) -> list[list[str]]:
    """Rows of a table with spans of rows and columns carried into every cell they cover."""
    import re

    out: list[list[str]] = []
    hanging: dict[int, tuple[int, str]] = {}
    for row in re.findall(r"(?is)<tr\b[^>]*>(.*?)</tr>", html):
        line: list[str] = []

        def carry() -> None:
            while len(line) in hanging:  # noqa: B023
                left, text = hanging.pop(len(line))  # noqa: B023
                if left > 1:
                    hanging_next[len(line)] = (left - 1, text)  # noqa: B023
                line.append(text)  # noqa: B023

        hanging_next: dict[int, tuple[int, str]] = {}
        for attributes, body in re.findall(r"(?is)<t[dh]\b([^>]*)>(.*?)</t[dh]>", row):
            carry()
            span = {k: int(v) for k, v in re.findall(r"(?i)(rowspan|colspan)\s*=\s*[\"']?(\d+)", attributes)}
            text = " ".join(re.sub(r"<[^>]+>", " ", body).split())
            for _ in range(max(span.get("colspan", 1), 1)):
                if span.get("rowspan", 1) > 1:
                    hanging_next[len(line)] = (span["rowspan"] - 1, text)
                line.append(text)
        carry()
        hanging = {**hanging, **hanging_next}
        out.append(line)
    return out


def unique_names(names: list[str]) -> list[str]:
    """Column names made unique: ``x``, ``x_2``; a blank name becomes ``col_i``."""
    seen: dict[str, int] = {}
    out = []
    for i, raw in enumerate(names, 1):
        name = " ".join((raw or "").split()) or f"col_{i}"
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out
