"""Operators on literal cases, and formats written and read again."""

import gzip
import math

import pytest

from spotgrain.operators import correction, sampling
from spotgrain.sources import formats

#: A substitution weighs 10^((33 - q) / 10) times one more than the count.
KNOWN = [("CCCC", 40), ("CCGG", 3), ("TTTT", 0)]


@pytest.mark.parametrize(
    ("seen", "quality", "want"),
    [
        ("CCCA", [63, 63, 63, 63], "CCCC"),  # the only one near
        ("CCCG", [60, 60, 60, 60], "CCCC"),  # 41 to 4: a share of 0.911
        ("CCCG", [60, 60, 50, 60], None),  # 41 x 10^-2.7 to 4 x 10^-1.7: 0.506
        ("CCCG", [60, 60, 40, 60], "CCGG"),  # 0.0818 to 0.798: 0.907
        ("TTTA", [66, 66, 66, 33], None),  # an expected error of 1 and more
        ("CCCC", [66, 66, 66, 66], None),  # known itself, and near no other
        ("GGGG", [66, 66, 66, 66], None),
    ],
)
def test_correct_barcodes(spark, seen, quality, want):
    o = spark.createDataFrame([(seen, quality)], "barcode string, quality array<int>")
    known = spark.createDataFrame(KNOWN, "barcode string, count long")
    assert [r.corrected for r in correction.correct_barcodes(o, known, 0.9).collect()] == [want]


def test_deduplicated(spark):
    # One read of AAA moves to AAC before the test, so gene 1 leads (4 to 3) and gene 2's AAC goes; the rest follows.
    rows = [("b", 1, "AAC", 3), ("b", 1, "AAA", 2), ("b", 2, "AAC", 3), ("b", 2, "GGG", 1), ("c", 1, "TTT", 2), ("c", 2, "TTT", 2)]
    df = spark.createDataFrame(rows, "barcode string, gene int, umi string, reads long")
    got = {tuple(r) for r in correction.deduplicated(df).select("barcode", "gene", "umi", "reads").collect()}
    assert got == {("b", 1, "AAC", 5), ("b", 2, "GGG", 1)}


def test_corrected_features(spark):
    known = spark.createDataFrame([("a", "AAA", 0.9), ("a", "AAT", 0.1), ("b", "CCC", 1.0)], "kind string, seq string, share double")
    seen = [("a", "AAT", [30, 30, 30]), ("a", "AAG", [30, 30, 30]), ("a", "CAA", [10, 10, 10]), ("b", "CCG", [5, 5, 5]), ("b", "GGG", [5, 5, 5])]
    df = spark.createDataFrame(seen, "kind string, seq string, quality array<int>")
    got = {(r.kind, r.seq): r.corrected for r in correction.corrected_features(df, known).collect()}
    assert got == {("a", "AAT"): "AAT", ("a", "AAG"): None, ("a", "CAA"): "AAA", ("b", "CCG"): "CCC", ("b", "GGG"): None}


def test_thinned(spark):
    m = spark.range(2000).selectExpr("id AS barcode", "id % 2 AS library", "10L AS reads")
    rates = spark.createDataFrame([(0, 0.3), (1, 0.0)], "library long, rate double")
    got = sampling.thinned(m, rates)
    assert {r.library for r in got.select("library").distinct().collect()} == {0}
    n = got.agg({"reads": "sum"}).first()[0]
    assert abs(n - 3000) < 6 * math.sqrt(10_000 * 0.3 * 0.7)
    assert sorted(got.collect()) == sorted(sampling.thinned(m.repartition(5), rates).collect())


def test_fastq(spark, tmp_path):
    reads = [("r1 a:b", "ACGT", "IIII"), ("r2", "GG", "@I"), ("r3", "TTT", "I@@"), ("r4", "C", "@")]
    (tmp_path / "x.fastq").write_text("".join(f"@{h}\n{s}\n+\n{q}\n" for h, s, q in reads))
    got = formats.read_fastq(spark, str(tmp_path / "x.fastq")).collect()
    assert sorted((r.header, r.seq, r.qual) for r in got) == reads
    one = spark.createDataFrame([("A00:12:HX:3:1101 1:N:0",)], "h string").select(formats.illumina_header("h").alias("h")).first().h
    assert tuple(one) == ("A00", 12, "HX", 3)


def test_fasta_gtf(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">c1 one\nACG\nTA\n>c2\nGG\n")
    got = formats.read_fasta(spark, str(tmp_path / "x.fa")).collect()
    assert sorted(map(tuple, got)) == [("c1", "one", "ACGTA"), ("c2", "", "GG")]
    line = 'c1\ts\texon\t{}\t{}\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; tag "a"; tag "b";\n'
    (tmp_path / "x.gtf").write_text("#!x\n" + line.format(1, 10) + line.format(21, 25))
    gtf = formats.read_gtf(spark, str(tmp_path / "x.gtf"))
    assert gtf.first().attributes == {"gene_id": "g1", "transcript_id": "t1", "tag": "a"}
    assert [tuple(r) for r in formats.genes_of(gtf).collect()] == [("g1", "t1", 2, 15)]


def test_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("#panel=x\n#version=1.0\na,b\n1,2\n")
    p = str(tmp_path / "p.csv")
    assert [tuple(r) for r in formats.read_commented_csv(spark, p, ("a",)).collect()] == [("1", "2")]
    with pytest.raises(ValueError, match="c"):
        formats.read_commented_csv(spark, p, ("a", "c"))
    assert {tuple(r) for r in formats.comment_metadata(spark, p).collect()} == {("panel", "x"), ("version", "1.0")}
    (tmp_path / "m.csv").write_text("[Libraries]\nid, path\n\n# no\n[samples]\ns1,x\n")
    assert [(r.section, r.fields) for r in formats.read_sections(spark, str(tmp_path / "m.csv")).collect()] == [("libraries", ["id", "path"]), ("samples", ["s1", "x"])]
    (tmp_path / "r.geojson").write_text('{"type": "FeatureCollection", "features": [{"properties": {"n": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}')
    assert [tuple(r) for r in formats.read_geojson(spark, str(tmp_path / "r.geojson")).collect()] == [('{"n":1}', "Point", "[1,2]")]


def test_mex(spark, tmp_path):
    m = spark.createDataFrame([(0, 0, 5), (2, 0, 2), (1, 3, 1)], "feature long, barcode long, umis long")
    f = spark.createDataFrame([(k, f"id{k}", f"n{k}", "Gene") for k in range(3)], "feature long, id string, name string, type string")
    b = spark.createDataFrame([(k, f"ACGT-{k}") for k in range(4)], "barcode long, name string")
    formats.write_mex(m, f, b, f"{tmp_path}/mex")
    assert sorted(formats.read_mex(spark, f"{tmp_path}/mex").collect()) == sorted(m.collect())
    lines = gzip.open(f"{tmp_path}/mex/matrix.mtx.gz", "rt").read().splitlines()
    assert lines == ["%%MatrixMarket matrix coordinate integer general", "3 4 3", "1 1 5", "3 1 2", "2 4 1"]
    assert gzip.open(f"{tmp_path}/mex/barcodes.tsv.gz", "rt").read() == "".join(f"ACGT-{k}\n" for k in range(4))
    assert gzip.open(f"{tmp_path}/mex/features.tsv.gz", "rt").readline() == "id0\tn0\tGene\n"
