"""Small files of each format, written by hand or by the engine, read again."""

import gzip
import json

import pytest

from spotgrain.sources import formats


def test_lists_and_positions(spark, tmp_path):
    (tmp_path / "w.txt").write_text("ACGT\tTGCA\nGGGG\n\n")
    assert [tuple(r) for r in formats.read_whitelist(spark, f"{tmp_path}/w.txt").collect()] == [("ACGT", "TGCA"), ("GGGG", "GGGG")]
    (tmp_path / "t.csv").write_text("barcode,in_tissue,array_row,array_col,pxl_row,pxl_col\nA-1,1,2,3,4.5,6\n")
    assert [tuple(r) for r in formats.read_tissue_positions(spark, f"{tmp_path}/t.csv").collect()] == [("A-1", 1, 2, 3, 4.5, 6.0)]


def test_parameters(spark, tmp_path):
    (tmp_path / "p.csv").write_text("# no\nclusters, 5\nseed,1\n")
    assert formats.read_parameters(spark, f"{tmp_path}/p.csv", ("clusters", "seed")) == {"clusters": "5", "seed": "1"}
    with pytest.raises(ValueError, match="clusters"):
        formats.read_parameters(spark, f"{tmp_path}/p.csv", ("seed",))


def test_json(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"reads": 5, "rate": 0.5}))
    assert {(r.name, r.value) for r in formats.read_metrics(spark, f"{tmp_path}/m.json").collect()} == {("reads", "5"), ("rate", "0.5")}
    (tmp_path / "c.json").write_text(json.dumps([{"barcode": "A", "umis": 2}, {"barcode": "B", "umis": 3}], indent=1))
    got = formats.read_contigs(spark, [f"{tmp_path}/c.json"], "barcode string, umis int").collect()
    assert {(r.barcode, r.umis) for r in got} == {("A", 2), ("B", 3)}
    assert all(r.dataset.endswith("c.json") for r in got)


def test_features_and_assignments(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,name,read,pattern,sequence,feature_type,target\nf1,n1,R2,5P(BC),ACGT,Tag,g1\nf2,n2,R2,(BC),GGGG,Tag,\n")
    got = formats.read_features(spark, f"{tmp_path}/f.csv").collect()
    assert [(r.id, r.tags) for r in got] == [("f1", {"target": "g1"}), ("f2", {})]
    (tmp_path / "s.csv").write_text("barcode,sample\nA,s1\nB,s2\n")
    assert formats.read_assignments(spark, f"{tmp_path}/s.csv", ("s1", "s2")).count() == 2
    (tmp_path / "s2.csv").write_text("barcode,sample\nA,s1\nA,s2\n")
    with pytest.raises(ValueError, match="repeated"):
        formats.read_assignments(spark, f"{tmp_path}/s2.csv", ("s1", "s2"))


def test_csv_and_fasta(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "x", y'), ("b", None)], "k string, v string")
    formats.write_csv(df, f"{tmp_path}/x.csv.gz")
    assert gzip.open(f"{tmp_path}/x.csv.gz", "rt").read() == 'k,v\na,"say ""x"", y"\nb,\n'
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("a,b\n3,4\n")
    assert sorted(tuple(r) for r in formats.combine_csv(spark, [f"{tmp_path}/1.csv", f"{tmp_path}/2.csv"]).collect()) == [("1", "2"), ("3", "4")]
    records = spark.createDataFrame([("c1", "ACGTACGT"), ("c2", "GG")], "name string, seq string")
    formats.write_fasta(records, f"{tmp_path}/x.fa.gz", 4)
    assert gzip.open(f"{tmp_path}/x.fa.gz", "rt").read() == ">c1\nACGT\nACGT\n>c2\nGG\n"
    assert {(r.name, r.seq) for r in formats.read_fasta(spark, f"{tmp_path}/x.fa.gz").collect()} == {("c1", "ACGTACGT"), ("c2", "GG")}


def test_molecules(spark, tmp_path):
    m = spark.range(100).selectExpr("id AS barcode", "id % 3 AS library", "id AS reads")
    formats.write_molecules(m, f"{tmp_path}/m")
    back = spark.read.parquet(f"{tmp_path}/m").selectExpr("barcode", "CAST(library AS BIGINT) AS library", "reads")
    assert sorted(back.collect()) == sorted(m.collect())
