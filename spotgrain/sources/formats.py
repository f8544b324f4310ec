"""Readers and writers of text formats: FASTQ, FASTA, GTF, CSV with comments or
sections, GeoJSON and MatrixMarket directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(name, header, seq, qual); a record is split where a header line follows
    a whole record, so files are cut between records and never collected."""
    # A header starts with @ and its third line with +; quality lines alone may start with @ too.
    raw = spark.read.option("lineSep", "\n@").text(path)
    lines = F.split(F.regexp_replace(F.col("value"), r"^@|\r|\n+\z", ""), "\n")
    r = raw.select(lines.alias("x"), F.input_file_name().alias("file"))
    # A quality line that starts with @ ends its record early: its piece has three lines, the piece behind it one.
    n = F.size("x")
    w = Window.partitionBy("file").orderBy("at")  # over such pieces only
    odd = r.withColumn("at", F.monotonically_increasing_id()).where(n != 4)
    odd = odd.select(F.concat("x", F.array(F.concat(F.lit("@"), F.lead(F.col("x")[0]).over(w)))).alias("x"), n.alias("n"))
    good = r.where(n == 4).select("x").unionByName(odd.where("n = 3").select("x"))
    return good.select(F.split(F.col("x")[0], r"\s")[0].alias("name"), F.col("x")[0].alias("header"), F.col("x")[1].alias("seq"), F.col("x")[3].alias("qual"))


def illumina_header(header):
    """struct(instrument, run, flowcell, lane) of a read's header."""
    p = F.split(F.split(header, r"\s")[0], ":")
    return F.struct(F.get(p, F.lit(0)).alias("instrument"), F.get(p, F.lit(1)).cast("int").alias("run"), F.get(p, F.lit(2)).alias("flowcell"), F.get(p, F.lit(3)).cast("int").alias("lane"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, description, seq), a row for each record."""
    raw = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*(\n|\z)", ""), r"\s", "")
    return raw.select(F.split(head, r"\s")[0].alias("name"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("description"), seq.alias("seq"))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """The nine columns of a GTF; attributes as a map of the quoted values."""
    t = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    c = F.split("value", "\t")
    keys = F.regexp_extract_all(c[8], F.lit(r'(\S+)\s+"([^"]*)"'), F.lit(1))
    values = F.regexp_extract_all(c[8], F.lit(r'(\S+)\s+"([^"]*)"'), F.lit(2))
    # A key given twice keeps its first value.
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    first = F.filter(pairs, lambda x, i: F.array_position(keys, x["k"]) == i + 1)
    return t.select(
        c[0].alias("seqname"), c[1].alias("source"), c[2].alias("feature"), c[3].cast("long").alias("start"), c[4].cast("long").alias("end"),
        c[5].alias("score"), c[6].alias("strand"), c[7].alias("frame"), F.map_from_entries(first).alias("attributes"),
    )


def genes_of(gtf: DataFrame) -> DataFrame:
    """Exons by transcript: gene, transcript, their count and summed length."""
    e = gtf.where("feature = 'exon'").select(F.col("attributes")["gene_id"].alias("gene"), F.col("attributes")["transcript_id"].alias("transcript"), (F.col("end") - F.col("start") + 1).alias("n"))
    return e.groupBy("gene", "transcript").agg(F.count("*").alias("exons"), F.sum("n").alias("length"))


def read_commented_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV with a header under lines of comments; names the missing columns."""
    df = spark.read.option("header", True).option("comment", "#").csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df


def comment_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a file's ``#key=value`` lines."""
    m = r"^#([^=]+)=(.*)$"
    t = spark.read.text(path).where(F.col("value").rlike(m))
    return t.select(F.trim(F.regexp_extract("value", m, 1)).alias("key"), F.trim(F.regexp_extract("value", m, 2)).alias("value"))


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """(section, fields) of a configuration file with ``[section]`` lines."""
    t = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("i", "line"), F.input_file_name().alias("file"))
    name = F.when(F.col("line").rlike(r"^\s*\[[^\]]+\]"), F.lower(F.trim(F.regexp_extract("line", r"\[([^\]]+)\]", 1))))
    t = t.withColumn("section", F.last(name, True).over(Window.partitionBy("file").orderBy("i")))
    rows = t.where(name.isNull() & F.col("section").isNotNull() & (F.trim("line") != "") & ~F.col("line").startswith("#"))
    return rows.select("section", F.transform(F.split("line", ","), lambda x: F.trim(x)).alias("fields"))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, kind, coordinates): a row for each feature; the last two columns but the kind as JSON."""
    t = spark.read.text(path, wholetext=True)
    shape = "struct<features:array<struct<properties:string,geometry:struct<type:string,coordinates:string>>>>"
    f = t.select(F.explode(F.from_json("value", shape)["features"]).alias("f"))
    return f.select("f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def write_single(lines: DataFrame, path: str, header: str | None = None) -> None:
    """The column ``value`` as one gzipped file, in the order of the
    partitions.  Tasks write and compress parts; the driver strings the parts
    together, a buffer at a time (gzip members in a row are one gzip file)."""
    spark = lines.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parts = f"{path}.parts"
    for name, df in (("0", None if header is None else spark.createDataFrame([(header,)], "value string").coalesce(1)), ("1", lines)):
        if df is not None:
            df.select("value").write.option("compression", "gzip").mode("overwrite").text(f"{parts}/{name}")
    target, folder = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(parts)
    fs = target.getFileSystem(conf)
    out = fs.create(target, True)
    for name in ("0", "1"):
        where = jvm.org.apache.hadoop.fs.Path(f"{parts}/{name}")
        if fs.exists(where):
            for f in sorted((x.getPath() for x in fs.listStatus(where) if x.getPath().getName().startswith("part-")), key=lambda x: x.getName()):
                source = fs.open(f)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                source.close()
    out.close()
    fs.delete(folder, True)


def write_mex(matrix: DataFrame, features: DataFrame, barcodes: DataFrame, path: str) -> None:
    """matrix.mtx.gz, features.tsv.gz and barcodes.tsv.gz.  ``features``:
    (feature, id, name, type) and ``barcodes``: (barcode, name), both with dense
    numbers from 0; the matrix has numbers from 1, sorted by barcode."""
    size = matrix.agg(F.count("*").alias("n")).first().n
    n_features, n_barcodes = features.count(), barcodes.count()
    m = matrix.select((F.col("feature") + 1).alias("feature"), (F.col("barcode") + 1).alias("barcode"), "umis").repartitionByRange("barcode").sortWithinPartitions("barcode", "feature")
    write_single(m.select(F.concat_ws(" ", "feature", "barcode", "umis").alias("value")), f"{path}/matrix.mtx.gz", f"%%MatrixMarket matrix coordinate integer general\n{n_features} {n_barcodes} {size}")
    write_single(features.orderBy("feature").select(F.concat_ws("\t", "id", "name", "type").alias("value")), f"{path}/features.tsv.gz")
    write_single(barcodes.orderBy("barcode").select(F.col("name").alias("value")), f"{path}/barcodes.tsv.gz")


def read_mex(spark: SparkSession, path: str) -> DataFrame:
    """(feature, barcode, umis), numbers from 0, of a MatrixMarket directory."""
    t = spark.read.text(f"{path}/matrix.mtx.gz", wholetext=False).withColumn("at", F.monotonically_increasing_id())
    body = t.where(~F.col("value").startswith("%"))
    # The first line behind the comments has the sizes; gzip is not split, so lines are in order.
    first = body.agg(F.min("at").alias("first"))
    c = F.split("value", r"\s+")
    body = body.crossJoin(F.broadcast(first)).where("at > first")  # one row
    return body.select((c[0].cast("long") - 1).alias("feature"), (c[1].cast("long") - 1).alias("barcode"), c[2].cast("long").alias("umis"))


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """(seq, translated) of a list of barcodes, one or two columns; a sequence
    without a translation stands for itself."""
    c = F.split(F.trim("value"), r"\t")
    t = spark.read.text(path).where(F.trim("value") != "")
    return t.select(c[0].alias("seq"), F.coalesce(F.get(c, F.lit(1)), c[0]).alias("translated"))


POSITIONS = "barcode string, in_tissue int, array_row int, array_col int, pxl_row double, pxl_col double"


def read_tissue_positions(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return spark.read.schema(POSITIONS).option("header", header).option("mode", "FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    """One gzipped file with a header, quoted where needed."""
    quote = lambda c: F.when(c.rlike(f'[{separator}"\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    cells = [F.coalesce(quote(F.col("`" + n + "`").cast("string")), F.lit("")) for n in df.columns]
    write_single(df.select(F.concat_ws(separator, *cells).alias("value")), path, separator.join(df.columns))


def combine_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSVs with the same header as one table; the headers are read once each."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(paths)


def read_parameters(spark: SparkSession, path: str, allowed: tuple[str, ...]) -> dict[str, str]:
    """The key,value lines of a small file; unknown and repeated keys are errors."""
    c = F.split("value", ",", 2)
    rows = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.trim(c[0]).alias("k"), F.trim(F.get(c, F.lit(1))).alias("v")).limit(10_000).collect()
    out: dict[str, str] = {}
    for k, v in rows:
        if k not in allowed or k in out or v is None:
            raise ValueError(f"parameter {k!r} is unknown, repeated or has no value")
        out[k] = v
    return out


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, value) of JSON objects of metrics; values as text."""
    t = spark.read.text(path, wholetext=True)
    return t.select(F.input_file_name().alias("file"), F.explode(F.from_json("value", "map<string,string>")).alias("name", "value"))


def read_contigs(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The objects of JSON arrays of contigs, with the file they are from."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(paths).withColumn("dataset", F.input_file_name())


FEATURE_COLUMNS = ("id", "name", "read", "pattern", "sequence", "feature_type")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A feature table: every column beyond the required ones is a tag."""
    df = read_commented_csv(spark, path, FEATURE_COLUMNS)
    tags = [c for c in df.columns if c not in FEATURE_COLUMNS]
    pairs = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").alias("value"))) for c in tags]
    empty = F.array().cast("array<struct<key:string,value:string>>")
    return df.select(*FEATURE_COLUMNS, F.map_from_entries(F.array_compact(F.array(*pairs)) if pairs else empty).alias("tags"))


def read_assignments(spark: SparkSession, path: str, samples: tuple[str, ...]) -> DataFrame:
    """(barcode, sample) of a user's table; unknown samples and barcodes that
    come twice are errors."""
    df = read_commented_csv(spark, path, ("barcode", "sample")).select("barcode", "sample")
    bad = df.where(~F.col("sample").isin(*samples)).unionByName(df.groupBy("barcode").agg(F.min("sample").alias("sample"), F.count("*").alias("n")).where("n > 1").drop("n")).limit(5).collect()
    if bad:
        raise ValueError(f"unknown sample or repeated barcode: {[tuple(r) for r in bad]}")
    return df


def write_molecules(molecules: DataFrame, path: str, by: str = "library") -> None:
    """Parquet, a folder for each library, sorted by barcode within files, so
    that a range of barcodes reads few row groups."""
    m = molecules.repartitionByRange(by, "barcode").sortWithinPartitions(by, "barcode")
    m.write.option("compression", "zstd").partitionBy(by).mode("overwrite").parquet(path)


def write_fasta(records: DataFrame, path: str, width: int = 60) -> None:
    """(name, seq) as one gzipped FASTA in the order of the names."""
    body = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    write_single(records.orderBy("name").select(F.concat(F.lit(">"), F.col("name"), F.lit("\n"), body).alias("value")), path)
