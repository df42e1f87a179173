import pytest
from pyspark.sql import functions as F

from spanforge.operators import hits as ho
from spanforge.sources import fasta, reports, sinks
from spanforge.streaming.incremental import follow


def put(path, text):
    path.write_text(text)
    return str(path)


def test_fasta_folder_and_list(spark, tmp_path):
    put(tmp_path / "a.fna", ">c1 first contig\nACGT\nAC\n>c2\nGG\n")
    put(tmp_path / "b.fasta", ">c1\nTTTT")
    put(tmp_path / "note.md", "x")
    files = fasta.expand_inputs(spark, str(tmp_path))
    got = {(r.genome_id, r.seq_id): (r.seq, r.seq_len) for r in fasta.read_fasta(spark, files).collect()}
    assert got == {("a", "c1"): ("ACGTAC", 6), ("a", "c2"): ("GG", 2), ("b", "c1"): ("TTTT", 4)}
    listing = put(tmp_path / "genomes.txt", f"# note\n{tmp_path}/a.fna\n\n")
    assert fasta.expand_inputs(spark, listing) == [f"{tmp_path}/a.fna"]


def test_hit_file_drops_bad_rows_and_keeps_order(spark, tmp_path):
    p = put(tmp_path / "h.tsv", "g\tEUK__a|1\t1e-5\t50\t90\t80\ng\tNCLDV__b|1\t1e-5\t50\t30\t80\ng\tshort\ng\tEUK__c|1\tx\t50\t90\t80\n")
    ranked = ho.rank_hits(reports.parse_hits(reports.text_lines(spark, p)))
    assert [r.target for r in ranked.orderBy("rank").collect()] == ["EUK__a|1", "NCLDV__b|1"]


def test_repeat_and_frameshift_reports(spark, tmp_path):
    p = put(tmp_path / "r.dat", "Tandem finder\n\nSequence: c1 extra\n\n\nParameters: 2 7\n\n1 10 3 2.0\n20 30 5\n\nSequence: c2\n\nParameters: 2\n\n5 9 2\n")
    got = sorted(tuple(r) for r in reports.read_tandem_repeats(spark, p).collect())
    assert got == [("c1", 0, 10, "period=3"), ("c1", 19, 30, "period=5"), ("c2", 4, 9, "period=2")]
    t = put(tmp_path / "t.tbl", "# head\nh1 c1 - VS000001 - 300 1 200 900 50 20 1e-9 50 0.1 80 1 0 some words\nh2 c1 - VS000001 - 300 1 200 900 1 9 1e-9 50 0.1 80 0 0\n")
    r = reports.parse_frameshift(spark.read.text(t)).collect()
    assert [(x.hit_id, x.start, x.end, x.strand, x.description) for x in r] == [("h1", 19, 50, "-", "some words")]


def test_small_tables(spark, tmp_path):
    ann = put(tmp_path / "m.tsv", "model_name\tpfam_signature\tsource_scope\nVS1\tPF1;;PF2\tx\nVS2\t\tCRESS-Rep\n")
    d = reports.read_named_table(spark, ann, ["model_name", "pfam_signature", "source_scope"])
    assert {r.model: r.required for r in reports.parse_signatures(d).collect()} == {"VS1": ["PF1", "PF2"], "VS2": ["Gemini_AL1"]}
    with pytest.raises(ValueError, match="lacks columns"):
        reports.read_named_table(spark, ann, ["nope"])
    names = put(tmp_path / "n.txt", "a # x\n\n# y\nb\n")
    assert sorted(r.model for r in reports.read_name_list(spark, names).collect()) == ["a", "b"]
    ids = put(tmp_path / "i.tsv", "stem\tid\ns1\tx\ns1\ty\n")
    with pytest.raises(ValueError, match="several ids"):
        reports.read_id_map(spark, ids)
    doms = reports.parse_domains(spark.createDataFrame([("#c",), ("\t".join(f"c{i}" for i in range(13)),), ("a\tb",)], "value string")).collect()
    assert [tuple(r) for r in doms] == [("c0", "c4", "c5", "c11", "c12")]
    fold = reports.parse_structure_hits(spark.createDataFrame([("q\tt\t1e-3\t9\t.5\t.6\t.7\t.8",)], "value string")).first()
    assert (fold.query, fold.tm) == ("q", 0.8)


def test_exports(spark, tmp_path):
    d = spark.createDataFrame(
        [("c 1", 9, 20, "e=1", 0.99996, "PPV", "VP", True, None, 3), ("c2", 0, 5, "e2", 0.12344, "NCLDV", "VP", False, "x;y", 0)],
        "scaffold string, start bigint, end bigint, eve_id string, final_confidence double, effective_eve_class string, ppv_subtype string, has_virus_specific boolean, region_classification string, gene_taxonomy_total int",
    )
    assert [r.value for r in sinks.bed_lines(d).collect()] == ["c 1\t9\t20\te=1\t1000\t.", "c2\t0\t5\te2\t123\t."]
    gff = [r.value for r in sinks.gff_lines(d, "src").collect()]
    assert gff[0] == "c%201\tsrc\tEVE\t10\t20\t1000\t.\t.\tID=e%3D1;Name=e%3D1;confidence=1.0000;effective_eve_class=PPV;ppv_subtype=VP;has_virus_specific=true;gene_taxonomy_total=3"
    assert gff[1].endswith("effective_eve_class=NCLDV;region_classification=x%3By")
    assert len(sinks.DETAILED_COLUMNS) == 66
    sinks.write_tsv(d, str(tmp_path / "d"), sinks.DETAILED_COLUMNS)
    back = spark.read.options(header=True, sep="\t").csv(str(tmp_path / "d"))
    assert back.columns == sinks.DETAILED_COLUMNS and {r.kfd for r in back.collect()} == {"."} and {r.final_confidence for r in back.collect()} == {"1.0000", "0.1234"}
    sinks.write_text(sinks.gff_lines(d), str(tmp_path / "g"), "##gff-version 3")
    lines = spark.read.text(str(tmp_path / "g")).collect()
    assert len(lines) == 3 and any(r.value == "##gff-version 3" for r in lines)
    sinks.write_region_sequences(d.select("eve_id", F.lit("ACGT").alias("region_seq")), str(tmp_path / "s"))
    assert sorted(r.eve_id for r in spark.read.parquet(str(tmp_path / "s")).collect()) == ["e2", "e=1"]
    e = spark.createDataFrame([("b", "c", 99.0, 1.0, 2.0), ("a", "b", 95.12345, 50.0, 60.0)], "a string, b string, ani double, af_a double, af_b double")
    from spanforge.operators.graph import edge_table

    edge_table(e).write.options(sep="\t", header=True).csv(str(tmp_path / "e"))
    assert sorted(r.ani for r in reports.read_edges(spark, str(tmp_path / "e")).collect()) == [95.1235, 99.0]


def test_stream_keeps_late_rows(spark, tmp_path):
    src, out, cp = (str(tmp_path / p) for p in ("in", "out", "cp"))
    spark.createDataFrame([("g1", 1), ("g2", 2), ("silent", -5)], "genome_id string, v int").write.parquet(src)
    job = lambda rows: rows.groupBy("genome_id").agg(F.sum("v").alias("v")).filter("v > 0")
    for _ in range(3):
        follow(spark, src, "genome_id string, v int", out, cp, job).awaitTermination()
        spark.createDataFrame([("g2", 9), ("g3", 3), ("silent", 1)], "genome_id string, v int").write.mode("append").parquet(src)
    assert sorted((r.genome_id, r.v) for r in spark.read.parquet(out).collect()) == [("g1", 1), ("g2", 20), ("g3", 6)]


def test_files_with_late_headers_in_any_order(spark, tmp_path):
    folder = tmp_path / "late"
    folder.mkdir()
    put(folder / "a.tsv", "# tool 1\n# more\nid\tdomain\tn\nx\tNCLDV\t3\ny\t\t4\n")
    put(folder / "b.tsv", "title\nn\tother\tid\tdomain\n# note\n7\t-\tz\tBAC\n\n8\n")
    got = reports.read_late_headers(spark, str(folder), ["id", "domain", "n"]).collect()
    assert sorted((r.source, r.id or "", r.domain, r.n) for r in got) == [("a.tsv", "x", "NCLDV", "3"), ("a.tsv", "y", None, "4"), ("b.tsv", "", None, "8"), ("b.tsv", "z", "BAC", "7")]
    put(folder / "c.tsv", "nothing\nhere\n")
    with pytest.raises(Exception, match="no header"):
        reports.read_late_headers(spark, str(folder), ["id", "domain", "n"]).collect()
