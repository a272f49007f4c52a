"""Scans of the text formats, and parsers of lines that are already a DataFrame (column value)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrayloom import schemas
from arrayloom.functions.seqfn import first_word, lenient_int
from arrayloom.operators.tiles import TILE, of_pieces

V = "value"


def read_fasta(spark: SparkSession, path: str, lower: bool = False) -> DataFrame:
    """(seqid, header, seq, length), one row a record; plain or gzip."""
    records = spark.read.option("lineSep", "\n>").text(path)
    body = F.regexp_replace(V, r"^>", "")
    parts = F.split(body, "\n", 2)
    seq = F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s+", "")
    out = records.where(F.trim(V) != "").select(F.trim(parts[0]).alias("header"), (F.lower(seq) if lower else seq).alias("seq"))
    return out.select(first_word(F.col("header")).alias("seqid"), "header", "seq", F.length("seq").cast("bigint").alias("length"))


def read_fasta_tiles(spark: SparkSession, path: str, lower: bool = False, size: int = TILE) -> DataFrame:
    """(seqid, header, length, tile, offset, bases): the records of FASTA files as tiles of `size` letters, whatever the
    length of a record; bases are empty in the one tile of a record without letters. Lines before a first header are left out.

    Lines are read in blocks of the files, all at once. A line's record and place follow from a scan of two levels: counts of
    headers and letters within its block, and sums over the blocks before it (a row each). Compressed files are one block."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no"), F.startswith(V, F.lit(">")).alias("head"), F.col(V).alias("line")
    )
    letters = F.when(F.col("head"), F.lit("")).otherwise(F.regexp_replace("line", r"\s+", ""))
    lines = lines.withColumn("letters", F.lower(letters) if lower else letters).withColumn("n", F.length("letters").cast("bigint"))
    upto = Window.partitionBy("file", "block").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumns({"heads": F.sum(F.col("head").cast("bigint")).over(upto), "sum": F.sum("n").over(upto)})
    blocks = lines.groupBy("file", "block").agg(F.max("heads").alias("m"), F.max("sum").alias("k"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("file").alias("f"), F.col("block").alias("b"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("m"), F.coalesce(F.sum("k").over(before), F.lit(0)).alias("k"))
    placed = lines.join(blocks, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    placed = placed.select("file", (F.col("heads") + F.col("m")).alias("record"), (F.col("sum") - F.col("n") + F.col("k")).alias("place"), "n", "head", "line", "letters").where("record > 0")
    # letters of the file before the record, and of the record
    records = placed.groupBy("file", "record").agg(F.min("place").alias("base"), F.sum("n").alias("length"), F.max(F.when(F.col("head"), F.trim(F.substring("line", 2, 1 << 30)))).alias("header"))
    rows = placed.where("n > 0").join(records, ["file", "record"]).select("file", "record", (F.col("place") - F.col("base")).alias("at"), "letters")
    tiles = of_pieces(rows, ["file", "record"], size).drop("offset")
    out = records.join(tiles, ["file", "record"], "left").withColumn("tile", F.coalesce("tile", F.lit(0)))
    return out.select(first_word(F.col("header")).alias("seqid"), "header", "length", "tile", (F.col("tile") * size).alias("offset"), F.coalesce("bases", F.lit("")).alias("bases"))


def read_sat(spark: SparkSession, path: str) -> DataFrame:
    """The 18-column repeat table, strict; comments and a header row are skipped."""
    rows = spark.read.schema(schemas.SAT).options(sep="\t", comment="#", quote="", nullValue="None", mode="PERMISSIVE").csv(path)
    return rows.where(F.col("project") != "project")


def check_fields(spark: SparkSession, path: str, schema: str = schemas.SAT) -> None:
    """Hold a '# Fields:' block, if there is one, against the schema."""
    said = spark.read.text(path).where(F.startswith(V, F.lit("#"))).select(F.regexp_replace(V, r"^#\s*(Fields:)?\s*", "").alias("f")).agg(F.concat_ws(",", F.collect_list("f"))).first()[0]
    found = [x for x in _fields(said) if x]
    if found and found != schemas.names(schema):
        raise ValueError(f"fields {found} do not match {schemas.names(schema)}")


def _fields(said: str | None) -> list[str]:
    return [x.strip() for x in (said or "").replace("\t", ",").split(",")]


def parse_sat(lines: DataFrame) -> DataFrame:
    """Lenient repeat rows: blank or malformed numbers become 0."""
    f = F.split(V, "\t")
    cols = []
    for i, c in enumerate(schemas.SAT.split(", ")):
        name, kind = c.split()
        x = F.get(f, F.lit(i))
        if kind in ("bigint", "int"):
            x = lenient_int(x).cast(kind)
        elif kind == "double":
            x = F.coalesce(x.try_cast("double"), F.lit(0.0))
        else:
            x = F.nullif(x, F.lit("None"))
        cols.append(x.alias(name))
    return lines.where(~F.startswith(V, F.lit("#")) & ~F.startswith(V, F.lit("project\t"))).select(cols)


def parse_bed(lines: DataFrame) -> DataFrame:
    """(seqid, start, end, period, strand): comments, blanks, short and impossible rows are skipped; period 1, strand +."""
    f = F.split(V, "\t")
    at = lambda i: F.get(f, F.lit(i))
    rows = lines.where((F.trim(V) != "") & ~F.startswith(V, F.lit("#"))).select(
        first_word(at(0)).alias("seqid"), at(1).try_cast("bigint").alias("start"), at(2).try_cast("bigint").alias("end"),
        F.coalesce(at(3).try_cast("int"), F.lit(1)).alias("period"), F.coalesce(F.when(at(5).isin("+", "-"), at(5)), F.lit("+")).alias("strand"),
    )
    return rows.where((F.col("start") >= 0) & (F.col("start") < F.col("end")))


def parse_gff3(lines: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Features with their attributes, and database cross references, as maps."""
    f = F.split(V, "\t")
    at = lambda i: F.get(f, F.lit(i))
    rows = lines.where((F.trim(V) != "") & ~F.startswith(V, F.lit("#")) & (F.size(f) >= 9)).select(
        at(0).alias("seqid"), at(1).alias("source"), at(2).alias("type"), at(3).try_cast("bigint").alias("start"), at(4).try_cast("bigint").alias("end"),
        at(5).alias("score"), at(6).alias("strand"), at(7).alias("phase"), F.str_to_map(F.rtrim(at(8), F.lit(";")), F.lit(";"), F.lit("=")).alias("attributes"),
    )
    refs = F.element_at("attributes", F.lit("Dbxref"))
    rows = rows.withColumn("dbxref", F.str_to_map(refs, F.lit(","), F.lit(":")))
    return rows.where(F.col("type").isin(only)) if only else rows


def repeatmasker_quality(lines: DataFrame) -> DataFrame:
    """RepeatMasker rows with their fields and a flag: ok, short, bad number, reversed."""
    f = F.split(F.trim(V), r"\s+")
    at = lambda i: F.get(f, F.lit(i))
    rows = lines.where((F.trim(V) != "") & ~F.regexp_like(F.trim(V), F.lit("^(SW|score)"))).select(
        F.size(f).alias("n"), at(4).alias("seqid"), at(5).try_cast("bigint").alias("start"), at(6).try_cast("bigint").alias("end"), at(10).alias("family")
    )
    flag = F.when(F.col("n") < 11, "short").when(F.col("start").isNull() | F.col("end").isNull(), "bad number").when(F.col("start") > F.col("end"), "reversed").otherwise("ok")
    return rows.withColumn("flag", flag)


def parse_repeatmasker(lines: DataFrame) -> DataFrame:
    return repeatmasker_quality(lines).where("flag = 'ok'").select("seqid", "start", "end", F.concat(F.lit("RM_"), "family").alias("type"))


def parse_trf_line(value: Column) -> Column:
    """struct of a detector's data line of 15 fields; null for another count."""
    f = F.split(F.trim(value), " ")
    kinds = [("start", "bigint"), ("end", "bigint"), ("period", "int"), ("copies", "double"), ("consensus_size", "int"), ("pmatch", "double"), ("indels", "double"), ("score", "double"),
             ("a", "double"), ("c", "double"), ("g", "double"), ("t", "double"), ("entropy", "double"), ("consensus", "string"), ("array", "string")]
    return F.when(F.size(f) == 15, F.struct(*[F.get(f, F.lit(i)).try_cast(k).alias(n) for i, (n, k) in enumerate(kinds)]))


def read_trf_dat(spark: SparkSession, path: str) -> DataFrame:
    """(head, no, fields of the data lines) of raw detector output; a folder of .dat files is read whole."""
    blocks = spark.read.option("lineSep", "Sequence:").option("pathGlobFilter", "*.dat").option("recursiveFileLookup", True).text(path)
    lines = blocks.withColumn("l", F.split(V, "\n")).select(F.trim(F.col("l")[0]).alias("head"), F.posexplode("l").alias("no", "value"))
    return lines.withColumn("r", parse_trf_line(V)).where("no > 0 AND r IS NOT NULL").select("head", "no", "r.*")


def read_trf_folder(spark: SparkSession, path: str, project: str) -> DataFrame:
    """(project, trf_id, head, fields of the data lines) of all .dat files of a folder: ids run on from 1 through the files in
    order of their paths, and through each in order of its lines. Files are numbered at once: places within a block of a file,
    and counts of the blocks before it (a row each)."""
    blocks = spark.read.option("lineSep", "Sequence:").option("pathGlobFilter", "*.dat").option("recursiveFileLookup", True).text(path)
    blocks = blocks.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.split(V, "\n").alias("l"))
    rows = blocks.select("file", "block", "at", F.trim(F.col("l")[0]).alias("head"), F.posexplode("l").alias("no", "value")).withColumn("r", parse_trf_line(V)).where("no > 0 AND r IS NOT NULL")
    counts = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("file").alias("f"), F.col("block").alias("b"), F.coalesce(before, F.lit(0)).alias("base"))
    rows = rows.withColumn("own", F.row_number().over(Window.partitionBy("file", "block").orderBy("at", "no")))
    out = rows.join(counts, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return out.select(F.lit(project).alias("project"), (F.col("base") + F.col("own")).alias("trf_id"), "head", "r.*")


def array_id_parts(array_id: Column) -> Column:
    """struct of an id name_start_end_length_period; the name may hold underscores."""
    rx = r"^(.*)_(\d+)_(\d+)_(\d+)_(\d+)$"
    g = lambda i, k: F.nullif(F.regexp_extract(array_id, rx, i), F.lit("")).cast(k)
    return F.struct(g(1, "string").alias("seqid"), g(2, "bigint").alias("start"), g(3, "bigint").alias("end"), g(4, "bigint").alias("length"), g(5, "int").alias("period"))


def read_table(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    """A tab-separated table of a fixed schema (.fai, gaps, k-mer profiles, monomers, families); comments are skipped."""
    return spark.read.schema(schema).options(sep="\t", comment="#", quote="", header=header).csv(path)


def read_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, length, content) of the files under a folder whose names match."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length", "content")


def missing_results(spark: SparkSession, base: str) -> DataFrame:
    """(assembly, has_fasta, has_sat) of assembly folders: which assemblies have no results yet."""
    found = read_files(spark, base, "*").select(F.regexp_extract("path", r"/(GC[AF]_[^/_]+(?:\.\d+)?)", 1).alias("assembly"), "path").where("assembly <> ''")
    return found.groupBy("assembly").agg(F.max(F.regexp_like("path", F.lit(r"\.(fa|fna|fasta)(\.gz)?$"))).alias("has_fasta"), F.max(F.regexp_like("path", F.lit(r"\.sat$"))).alias("has_sat"))


# Places of the fields kept of a row of the old 37-column layout, by their present names.
LEGACY = {
    "project": 0, "trf_id": 2, "trf_family": 4, "trf_l_ind": 6, "trf_r_ind": 7, "trf_period": 8, "trf_n_copy": 9, "trf_pmatch": 10, "trf_pvar": 11,
    "trf_entropy": 12, "trf_consensus": 13, "trf_array": 14, "trf_array_gc": 15, "trf_consensus_gc": 16, "trf_head": 18, "trf_array_length": 20, "trf_joined": 22, "trf_ref_annotation": 33,
}


def parse_versions(lines: DataFrame, layouts: dict[int, dict[str, int]], types: dict[str, str]) -> DataFrame:
    """Rows of tables of several ages: the number of fields of a line tells its layout (fields by name and place). Columns
    are those of types; a field that a layout lacks, and the text None, is null; a line of another number of fields is
    an error when the rows are read."""
    f = F.split(V, "\t", -1)

    def field(name: str, kind: str) -> Column:
        by = F.lit(None).cast("string")
        for n, places in layouts.items():
            if name in places:
                by = F.when(F.size(f) == n, F.get(f, F.lit(places[name]))).otherwise(by)
        return F.nullif(by, F.lit("None")).cast(kind).alias(name)

    known = F.size(f).isin(*layouts)
    rows = lines.where((F.trim(V) != "") & ~F.startswith(V, F.lit("#")))
    checked = F.when(known, F.col(V)).otherwise(F.raise_error(F.concat(F.lit("a line of "), F.size(f).cast("string"), F.lit(" fields"))).cast("string"))
    return rows.select(checked.alias("value")).select(*[field(n, t) for n, t in types.items()])


# The columns of a telomere report.
TELOMERES = "chr string, length bigint, left_consec bigint, left_total bigint, left_density double, left_status string, right_consec bigint, right_total bigint, right_density double, right_status string, t2t_status string"


def read_telomeres(spark: SparkSession, path: str) -> DataFrame:
    """A telomere report with a flag for sequences complete at both ends."""
    return read_table(spark, path, TELOMERES, header=True).withColumnRenamed("chr", "seqid").withColumn("t2t", F.col("t2t_status") == "T2T")


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Interstitial sites of a BED file: (seqid, sites), in order of place."""
    rows = read_table(spark, path, "seqid string, start bigint, end bigint, repeats bigint")
    return rows.groupBy("seqid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "repeats"))).alias("sites"))


def stockholm_totals(spark: SparkSession, path: str) -> DataFrame:
    """(type, n, total) of records closed by //: how many of each type (#=GF TP) and how many sequences (#=GF SQ)."""
    records = spark.read.option("lineSep", "\n//").text(path)  # a // within a line, as of an address, ends no record
    get = lambda tag: F.trim(F.regexp_extract(V, rf"#=GF {tag}\s+([^\n]+)", 1))
    rows = records.select(get("ID").alias("id"), get("TP").alias("type"), get("SQ").try_cast("bigint").alias("n_seqs")).where("id <> ''")
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_seqs"), F.lit(0)).alias("total"))


def read_dictionary(spark: SparkSession, path: str, value: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(key, value) of a two-column file; value makes a column of the second field."""
    return read_table(spark, path, "key string, value string").select("key", value(F.col("value")).alias("value"))


def parse_dictionary(lines: DataFrame, value: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(key, value) of lines of two fields; lines of one field are left out, further fields are not read."""
    cut = F.split(F.col(V), "\t")
    rows = lines.where(F.size(cut) > 1).select(cut[0].alias("key"), cut[1].alias("value"))
    return rows.select("key", value(F.col("value")).alias("value"))


def transformed(lines: DataFrame, before: Callable[[Column], Column] | None = None, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Lines for a parser: changed by before, those that keep accepts."""
    rows = lines.select((before(F.col(V)) if before else F.col(V)).alias("value"))
    return rows.where(keep(F.col(V))) if keep else rows
