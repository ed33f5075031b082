"""Operators and file formats on small tables made by hand."""

import gzip
import os
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cladeframe.functions import text
from cladeframe.operators import alignment, filters, groups, hits, ids, labels, report, sequences, taxonomy
from cladeframe.plans import pipelines
from cladeframe.sources import readers, writers


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression).first()[0]


GENBANK = '''LOCUS       ctg1                 120 bp    DNA
SOURCE      Some bug
  ORGANISM  Some bug sp. A/1
            Bacteria.
FEATURES             Location/Qualifiers
     source          1..120
                     /organism="Some bug"
                     /strain="K-12"
                     /db_xref="taxon:562"
     CDS             1..30
                     /locus_tag="L1"
                     /note="fine"
                     /translation="MKV
                     LST"
     CDS             complement(40..60)
                     /translation="MA"
     CDS             join(1..3,7..9)
                     /locus_tag="L3"
                     /translation="MB"
     CDS             <1..9
                     /locus_tag="L4"
                     /translation="MC"
     CDS             10..19
                     /locus_tag="L5"
                     /note="frameshifted; incomplete"
                     /translation="MD"
     CDS             20..29
                     /locus_tag="L6"
                     /pseudo
                     /translation="ME"
ORIGIN
        1 acgtacgtac gtacgt
       17 ttt
//
LOCUS       ctg2                 9 bp    DNA
FEATURES             Location/Qualifiers
     source          1..9
                     /strain="other"
ORIGIN
        1 ggggg
//
'''


def test_genbank(spark, tmp_path):
    (tmp_path / "g1.gb").write_text(GENBANK)
    path = f"{tmp_path}/g1.gb"
    cds = readers.read_genbank(spark, path)
    assert cds.count() == 6
    assert rows(sequences.cds_to_sequences(sequences.filter_cds(cds))) == [("g1", "L1", "MKVLST", 6), ("g1", "ctg1_40_60", "MA", 2)]
    assert rows(readers.read_genbank_contigs(spark, path)) == [("g1", "ctg1", "acgtacgtacgtacgtttt"), ("g1", "ctg2", "ggggg")]
    assert rows(readers.genbank_metadata(readers.genbank_records(spark, path))) == [("g1", "Some_bug_sp_A_1", "K-12", "562")]


def test_fasta(spark, tmp_path):
    (tmp_path / "a.b.fa").write_text(">x one\nACG\nT*\n>y\n\n>z>q\nGG\n")
    with gzip.open(tmp_path / "c.fa.gz", "wt") as f:
        f.write(">x\nAA\n")
    seqs = readers.read_fasta(spark, [f"{tmp_path}/a.b.fa", f"{tmp_path}/c.fa.gz"])
    assert rows(seqs) == [("a.b", 0, "x", "x one", "ACGT*", 5), ("a.b", 1, "y", "y", "", 0), ("a.b", 2, "z>q", "z>q", "GG", 2), ("c", 0, "x", "x", "AA", 2)]
    assert rows(readers.read_fasta(spark, f"{tmp_path}/a.b.fa", per_file_order=False), "gene_id", "seq") == [("x", "ACGT*"), ("y", ""), ("z>q", "GG")]
    assert rows(sequences.rename_sequential(sequences.strip_stops(seqs)), "gene_id", "seq") == [("a.b_1", "ACGT"), ("a.b_2", ""), ("a.b_3", "GG"), ("c_1", "AA")]
    assert rows(filters.filter_by_length(seqs, 2, 2), "seq") == [("AA",), ("GG",)]
    with pytest.raises(ValueError):
        sequences.reorder(seqs, spark.createDataFrame([("nobody", 1)], "id string, ord long"))


def test_hit_tables_and_profiles(spark, tmp_path):
    (tmp_path / "g.tbl").write_text("# head\ng_1 - Rib PF1.2 1e-9 50.5 0\ng_2   -  Rib  PF1.2  1e-3 9 0\n\n")
    assert rows(readers.read_hits(spark, f"{tmp_path}/g.tbl"), "genome_id", "gene_id", "marker", "marker_acc", "evalue", "score") == [("g", "g_1", "Rib", "PF1.2", 1e-9, 50.5), ("g", "g_2", "Rib", "PF1.2", 1e-3, 9.0)]
    (tmp_path / "set.hmm").write_text("HMMER3\nNAME  Rib\nACC   PF1.2\nx\n//\nHMMER3\nNAME  Two\nACC   PF2.1\n//\n")
    profiles = readers.read_profiles(spark, f"{tmp_path}/set.hmm")
    assert rows(profiles, "profile_set", "marker", "acc") == [("set", "Rib", "PF1.2"), ("set", "Two", "PF2.1")]
    assert rows(readers.profile_counts(profiles)) == [("set", 2)]
    (tmp_path / "k.tsv").write_text("g1\tK1\ng2\ng3\t\n")
    assert rows(readers.read_ko_hits(spark, f"{tmp_path}/k.tsv")) == [("k", "g1", "K1")]
    (tmp_path / "pfam.tsv").write_text("\t".join(["PF1", "short", "x", "Long name", *["x"] * 23, "7", *["x"] * 5, "61.5"]) + "\n")
    assert rows(readers.read_pfam_info(spark, f"{tmp_path}/pfam.tsv")) == [("PF1", "short", "Long name", "7", 61.5)]


def test_assembly_summary_without_header(spark, tmp_path):
    (tmp_path / "t.txt").write_text("\t".join(str(k) for k in range(20)) + "\nshort\n")
    assert rows(readers.read_assembly_summary(spark, f"{tmp_path}/t.txt")) == [("0", "5", "7", "8", "10", "11", "15", "19")]
    (tmp_path / "u.txt").write_text("#assembly_accession\ttaxid\n1\t2\n")
    with pytest.raises(ValueError):
        readers.read_assembly_summary(spark, f"{tmp_path}/u.txt")


def test_writers(spark, tmp_path):
    aln = spark.createDataFrame([("m1", 1, "AC-"), ("m2", 1, "GG"), ("m1", 2, "A--")], "marker string, genome_id int, seq string")
    table = alignment.partition_table(aln)
    assert rows(table) == [(1, "m1", 1, 3), (2, "m2", 9, 10)]
    writers.write_lines(alignment.partition_lines(table, "nexus"), f"{tmp_path}/nexus")
    assert [r.value for r in spark.read.text(f"{tmp_path}/nexus").collect()] == ["#NEXUS", "begin sets;", "charset m1 = 1-3;", "charset m2 = 9-10;", "end;"]
    assert [r.line for r in alignment.partition_lines(table, mode="nt").collect()] == ["DNA, m1 = 1-3", "DNA, m2 = 9-10"]
    with pytest.raises(ValueError):
        report.itol_colors(spark.createDataFrame([("a",)], "id string"), color="pink")


def test_counts_have_zeros_and_ties_are_settled(spark):
    h = spark.createDataFrame([("a", "g1", "m1", 1.0, 1), ("a", "g2", "m1", 1.0, 0), ("a", "g3", "m2", 2.0, 2), ("b", "g4", "other", 1.0, 3)], "genome_id string, gene_id string, marker string, evalue double, ord long")
    genomes = spark.createDataFrame([("a",), ("b",), ("c",)], "genome_id string")
    counts = hits.hit_counts(h, genomes, ["m1", "m2"])
    assert rows(counts) == [("a", "m1", 2), ("a", "m2", 1), ("b", "m1", 0), ("b", "m2", 0), ("c", "m1", 0), ("c", "m2", 0)]
    assert rows(hits.genome_quality(counts, 2)) == [("a", 2, 1, 1, 100.0, 50.0), ("b", 0, 0, 0, 0.0, 0.0), ("c", 0, 0, 0, 0.0, 0.0)]
    assert rows(hits.select_best_hit(h), "gene_id") == [("g2",), ("g3",), ("g4",)]
    assert rows(hits.select_single_copy(h), "gene_id") == [("g3",), ("g4",)]


def test_rounding_is_half_to_even(spark):
    quality = hits.genome_quality(spark.createDataFrame([("a", "m", 1)], "genome_id string, marker string, n long"), 32)
    assert quality.first().perc_comp == 3.12
    lengths = spark.createDataFrame([("m", 100), ("m", 125)], "marker string, len long")
    assert tuple(filters.length_bounds(lengths, 0.0).first()) == ("m", 112.5, 112.0, 112.0)
    assert filters.genome_cutoff(25, 0.5) == 12 and filters.genome_cutoff(1, 0.1) == 1


def test_markers_and_genomes_are_retained(spark):
    h = spark.createDataFrame([("a", "m1"), ("b", "m1"), ("c", "m1"), ("a", "m2")], "genome_id string, marker string")
    kept, removed = filters.retain_markers(h, spark.createDataFrame([("m1",), ("m2",), ("m3",)], "marker string"))
    assert rows(kept) == [("m1", 3)] and rows(removed) == [("m2", 1, "too few hits"), ("m3", 0, "no hits")]
    genomes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "genome_id string")
    kept, removed = filters.retain_genomes(h.where("marker = 'm1'"), genomes, 1)
    assert rows(removed) == [("d", 0)] and kept.count() == 3
    with pytest.raises(ValueError):
        filters.retain_genomes(h, genomes, 4)


def test_ids(spark):
    v = spark.createDataFrame([("a b",), ("x\r",), ("x\r",), ("t\tt",), ("ok",)], "id string")
    assert rows(ids.check_ids(v)) == [("carriage return", "x\r", 2), ("duplicate", "x\r", 2), ("space", "a b", 1), ("tab", "t\tt", 1)]
    assert ("x",) in rows(ids.repair_ids(v))
    pair = spark.createDataFrame([("GCA_1.1",), ("GCF_1.2",), ("GCA_2.1",)], "id string")
    assert ids.dedupe_accessions(pair)[0].count() == 3
    assert rows(ids.dedupe_accessions(pair, ignore_version=True)[0]) == [("GCA_2.1",), ("GCF_1.2",)]
    m = spark.createDataFrame([(1, "a(b", None), (2, "same", "s"), (3, "same", "s")], "genome_id int, label string, suffix string")
    assert rows(ids.check_label_map(m)) == [("duplicate", "same", "s", 2), ("forbidden character", "a(b", None, 1)]


def test_texts(spark):
    assert one(spark, "A (b)/c__d_", text.label_text("v")) == "A_b_c_d"
    assert one(spark, "sp. [x];'y'", text.label_text("v", species=True)) == "sp_xy"
    assert one(spark, "a: b,;c", text.screen_label("v")) == "a_b_c"
    assert one(spark, "/x/y/g.1.fa.gz", text.genome_name("v")) == "g.1"
    assert one(spark, "  ", text.clean("v")) == "NA"
    assert one(spark, "GCF_000001.2", text.base_link(F.lit("na"), F.col("v"), F.lit("x"), "b")) == "na"


def test_alignments(spark):
    aln = spark.createDataFrame([("m1", 1, "A-C-"), ("m1", 2, "A--T"), ("m2", 1, "GG")], "marker string, genome_id int, seq string")
    assert rows(alignment.trim_columns(aln, 0.4)) == [("m1", 1, "A"), ("m1", 2, "A"), ("m2", 1, "GG")]
    genomes = spark.createDataFrame([(1,), (2,), (3,)], "genome_id int")
    full = alignment.complete_with_gaps(aln, genomes)
    assert rows(alignment.concat_alignments(full)) == [(1, "A-C-XXXXXGG"), (2, "A--TXXXXX--"), (3, "----XXXXX--")]
    assert alignment.drop_all_gap(full).count() == 3
    named = spark.createDataFrame([(1, "one")], "genome_id int, label string")
    joined, parts = pipelines.supermatrix(aln, genomes, named, max_gap=0.4)
    assert rows(joined) == [("2", "AXXXXX--"), ("3", "-XXXXX--"), ("one", "AXXXXXGG")] and parts.count() == 2
    with pytest.raises(ValueError):
        pipelines.supermatrix(aln.unionByName(spark.createDataFrame([("m2", 9, "G")], aln.schema)), genomes)


def test_taxonomy_errors(spark):
    g = spark.createDataFrame([("RS_1", "X", "Y", "t"), ("RS_2", "Y", None, "f")], "accession string, phylum string, class string, gtdb_representative string").withColumn("ncbi_refseq_category", F.lit("na"))
    ranks = ["phylum", "class"]
    with pytest.raises(ValueError, match="several"):
        taxonomy.taxon_search(g, "Y", ranks=ranks)
    with pytest.raises(ValueError):
        taxonomy.taxon_search(g, "Z", ranks=ranks)
    assert rows(taxonomy.taxon_search(g, "Y", "PHYLUM", ranks=ranks), "accession") == [("RS_2",)]
    assert taxonomy.taxon_search(g, "all", reps="gtdb", ranks=ranks).count() == 1
    with pytest.raises(Exception, match="ranks"):
        taxonomy.split_lineage(spark.createDataFrame([("d__A;p__B",)], "l string"), "l").collect()


def test_lineages_of_deep_and_broken_trees(spark):
    deep = [(k, k - 1 if k > 1 else 1, "class" if k == 2 else "species" if k == 20 else "no rank") for k in range(1, 21)] + [(50, 49, "species")]
    nodes = spark.createDataFrame(deep, "taxid long, parent long, rank string")
    known = spark.createDataFrame([(k, f"n{k}") for k in (2, 20, 50)], "taxid long, name string")
    got = taxonomy.resolve_lineage(spark.createDataFrame([(20,), (50,), (99,)], "taxid long"), nodes, known, ["class", "species"])
    assert rows(got) == [(20, "n2", "n20"), (50, "NA", "n50"), (99, "NA", "NA")]


def test_label_precedence(spark):
    genomes = spark.createDataFrame([(k,) for k in range(1, 6)], "genome_id long")
    own = spark.createDataFrame([(1, "Mine", "x"), (2, None, "y z")], "genome_id long, label string, suffix string")
    g, n = (spark.createDataFrame(r, "genome_id long, label string") for r in ([(1, "1_G"), (3, "3_G")], [(2, "2_N"), (3, "3_N"), (4, "4_N")]))
    want = [(1, "Mine_x", "user_map_and_appended"), (2, "2_N_NCBI_y_z", "NCBI_and_appended"), (3, "3_G", "GTDB"), (4, "4_N_NCBI", "NCBI"), (5, "5", "input")]
    assert rows(labels.final_labels(genomes, own, g, n)) == want
    assert rows(labels.final_labels(genomes, own, None, n))[3] == (4, "4_N", "NCBI")


def test_failures_of_groups_are_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 0)], "k string, v int")
    out, errors = groups.map_groups(df, ["k"], lambda p: pd.DataFrame({"inverse": [1 / int(v) for v in p["v"]]}), T.StructType().add("k", "string").add("inverse", "double"))
    assert rows(out) == [("a", 0.5), ("a", 1.0)]
    [(k, error)] = rows(errors)
    assert k == "b" and "ZeroDivisionError" in error


def test_sequences_are_numbered_in_ranges(spark):
    given = [(g, (o % 7 << 33) + o * o, f"x{o}") for g in ("a", "b", None) for o in range(95)] + [("a", None, "none"), ("one", 7, "y")]
    df = spark.createDataFrame(given, "genome_id string, gene_ord long, gene_id string")
    for table in (df, df.withColumn("seq", F.concat("gene_id", F.lit("ACGT")))):
        got = {(r.genome_id, r.gene_ord): r.gene_id for r in sequences.prefix_headers(table.withColumn("p", F.lit("p")), "p").collect()}
        assert len(got) == len(given)
        for g, o, name in given:
            n = sum(x == g and (-1 if y is None else y) <= (-1 if o is None else o) for x, y, _ in given)
            assert got[g, o] == f"p_{name}_{n}"
        assert sequences.rename_sequential(table).columns == table.columns
        within = {r.gene_id for r in sequences.prefix_headers(table.withColumn("t", F.col("gene_ord") % 2), ["t"], ["genome_id", "t"]).where("genome_id = 'one'").collect()}
        assert within == {"1_y_1"}
    with pytest.raises(Exception, match="several sequences"):
        sequences.rename_sequential(df.unionAll(df).withColumn("seq", F.lit("A"))).collect()


def ranges_and_sizes(spark, rows):
    from cladeframe.operators.sequences import numbers

    df = numbers(spark.createDataFrame(rows, "genome_id string, gene_ord long").repartition(4), ["genome_id"], ["gene_ord"])
    return {(r.genome_id, r.gene_ord): r.n for r in df.collect()}


def test_numbers_of_a_large_genome_with_jumps(spark):
    rows = [("big", (i // 1000 << 33) + i) for i in range(8000)] + [("small", 5), ("small", 9)]
    got = ranges_and_sizes(spark, rows)
    assert got["small", 5] == 1 and got["small", 9] == 2
    assert all(got["big", (i // 1000 << 33) + i] == i + 1 for i in range(8000))


def exchanged(df):
    """Names of the columns that the plan's exchanges move."""
    import re

    plan = df._jdf.queryExecution().executedPlan().toString()
    below, out = plan.splitlines(), []
    for k, line in enumerate(below):
        if "Exchange" in line and "Broadcast" not in line:
            depth = len(re.match(r"[\s:+\-|*()0-9]*", line)[0])
            for under in below[k + 1 :]:
                if len(re.match(r"[\s:+\-|*()0-9]*", under)[0]) <= depth:
                    break
                out.append(under)
    return "\n".join(out)


def test_a_store_is_read_in_place(spark):
    from cladeframe.sources import store

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seqs = store.write_store(spark.createDataFrame([(f"g{i % 5}", i, "ACGT" * i, 4 * i) for i in range(200)], "genome_id string, gene_ord long, seq string, len int"))
        named = sequences.rename_sequential(seqs, stored=True)
        assert named.count() == 200 and "seq#" not in exchanged(named)
        chosen = sequences.gene_names(seqs).where("len % 3 = 0").withColumn("marker", F.lit("m"))
        got = hits.fetch_hit_seqs(chosen, seqs)
        assert "seq#" not in exchanged(got) and "Exchange" in got._jdf.queryExecution().executedPlan().toString()
        assert got.where("len <> length(seq)").count() == 0 and got.count() == chosen.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(Exception, match="without gene_ord"):
        store.write_store(spark.createDataFrame([("g", None, "A")], "genome_id string, gene_ord long, seq string"))


def test_markers_emptied_by_their_lengths_go(spark):
    genomes = spark.createDataFrame([(g,) for g in "abcd"], "genome_id string")
    genes = spark.createDataFrame([(g, k, "A" * n, n) for g, sizes in (("a", (100, 10)), ("b", (104, 1000)), ("c", (96, 50)), ("d", (100, 3))) for k, n in enumerate(sizes)], "genome_id string, gene_ord long, seq string, len int")
    found = [(g, f"{g}_1", "even") for g in "abcd"] + [("a", "a_2", "torn"), ("b", "b_2", "torn"), ("c", "c_2", "lone")]
    hit_rows = spark.createDataFrame([(*h, 1.0, 1) for h in found], "genome_id string, gene_id string, marker string, evalue double, ord long")
    out = pipelines.marker_sets(hit_rows, genes, genomes, ["even", "torn", "lone", "never"])
    assert rows(out["kept_markers"]) == [("even", 4)]
    assert sorted(rows(out["removed_markers"])) == [("lone", 1, "too few hits"), ("never", 0, "no hits"), ("torn", 2, "all filtered by length")]
    assert {r.marker for r in out["sequences"].collect()} == {"even"} and out["sequences"].count() == 4


def test_label_map_faults(spark):
    table = spark.createDataFrame([("a\\b", None), ("plain", "x"), ("plain", "x"), ("ok", "[y]"), ("fine", None)], "label string, suffix string")
    assert sorted(rows(ids.check_label_map(table)), key=str) == sorted([("forbidden character", "a\\b", None, 1), ("forbidden character", "ok", "[y]", 1), ("duplicate", "plain", "x", 2)], key=str)


def test_folders_without_a_scheme_are_of_the_default_file_system(spark):
    from cladeframe.scratch import qualified

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert qualified(spark, "/tmp/x/") == qualified(spark, "file:/tmp/x") == "file:///tmp/x"
    conf.set("fs.viewfs.mounttable.elsewhere.link./shared", "file:///tmp")
    conf.set("fs.defaultFS", "viewfs://elsewhere")
    try:
        assert qualified(spark, "/shared/x") == "viewfs://elsewhere/shared/x" and qualified(spark, "file:/tmp/x") == "file:///tmp/x"
    finally:
        conf.set("fs.defaultFS", before)


def test_lineages_climb_from_the_wanted_ids(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank"), (2, 1, "class"), (3, 2, "species"), (4, 9, "species"), (5, 6, "class"), (6, 5, "species")], "taxid long, parent long, rank string")
    known = spark.createDataFrame([(k, f"n{k}") for k in range(1, 7)], "taxid long, name string")
    got = taxonomy.resolve_lineage(spark.createDataFrame([(3,), (4,), (6,), (8,), (3,)], "taxid long"), nodes, known, ["class", "species"])
    assert sorted(rows(got)) == [(3, "n2", "n3"), (4, "NA", "n4"), (6, "n5", "n6"), (8, "NA", "NA")]


def test_places_in_a_split_file(spark, tmp_path):
    (tmp_path / "big.fa").write_text("; a comment\n" + "".join(f">g{i} x\n{'ACGT' * (i % 50)}\n" for i in range(4000)))
    (tmp_path / "big.tbl").write_text("".join(f"# no\ng{i} - m PF1 1e-9 {i}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        seqs = readers.read_fasta(spark, f"{tmp_path}/big.fa")
        assert seqs.rdd.getNumPartitions() > 5
        assert {(r.gene_ord, r.gene_id, r.len) for r in seqs.collect()} == {(i, f"g{i}", 4 * (i % 50)) for i in range(4000)}
        assert {(r.ord, r.gene_id) for r in readers.read_hits(spark, f"{tmp_path}/big.tbl").collect()} == {(2 * i + 1, f"g{i}") for i in range(4000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_named_file_has_many_writers(spark, tmp_path):
    from cladeframe.sources import named_files

    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 'small', 'large') as name", "if(id % 100 = 7, null, concat('line ', id, if(id % 5 = 0, '\nmore é', ''))) as line", "-id as ord").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pieces = named_files.pieces_of(df.where("line is not null"), ["ord"], 4096)
    try:
        assert pieces.where("name = 'large'").select("span").distinct().count() > 2 and pieces.agg(F.max("size")).first()[0] < 4200
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folder = f"{tmp_path}/files"
    named_files.write_named(df, folder, "name", "line", ["ord"], ".txt", piece=4096)
    named_files.write_named(df.where("name = 'small'"), folder, "name", "line", ["ord"], ".txt", piece=512)  # again, in the same folder
    want = {n: [f"line {i}" + ("\nmore é" if i % 5 == 0 else "") for i in reversed(range(20_000)) if (i % 3 == 0) == (n == "small") and i % 100 != 7] for n in ("small", "large")}
    assert sorted(os.listdir(folder)) == ["large.txt", "small.txt"]
    for n, lines in want.items():
        assert Path(folder, f"{n}.txt").read_text() == "\n".join(lines) + "\n"
    with pytest.raises(Exception, match="no name of a file"):
        named_files.write_named(df.withColumn("name", F.lit("a/b")), folder, "name", "line", ["ord"])
    with pytest.raises(ValueError, match="shared"):
        named_files.write_named(df, "hdfs://nowhere/x", "name", "line", ["ord"])


def test_gaps_are_laid_out_in_one_aggregate(spark):
    import random

    rng = random.Random(4)
    wide = {f"m{k:02d}": rng.randint(1, 9) for k in range(12)}
    given = [(m, g, "".join(rng.choice("AC-") for _ in range(w))) for m, w in wide.items() for g in range(30) if rng.random() < 0.4]
    aln = spark.createDataFrame(given, "marker string, genome_id int, seq string")
    genomes = spark.createDataFrame([(g,) for g in range(2, 34)], "genome_id int")  # some have no row, and some rows no genome
    for mode in ("aa", "nt"):
        want = rows(alignment.concat_alignments(alignment.complete_with_gaps(aln, genomes), mode))
        assert rows(alignment.concat_complete(aln, genomes, mode)) == want and len(want) == 32
    have = {(m, g): s for m, g, s in given}
    used = [m for m in sorted(wide) if any((m, g) in have for g in range(30))]
    assert want == sorted(((g, "NNNNNN".join(have.get((m, g), "-" * wide[m]) for m in used)) for g in range(2, 34)), key=str)


def test_trimming_counts_each_column(spark):
    given = [("m", 1, "A-C-é"), ("m", 2, "A--T-"), ("m", 3, "AG"), ("n", 1, "---"), (None, 1, "A"), ("o", 1, "")]
    aln = spark.createDataFrame(given, "marker string, genome_id int, seq string").repartition(4)
    assert rows(alignment.trim_columns(aln, 0.5)) == sorted([("m", 1, "AC-é"), ("m", 2, "A-T-"), ("m", 3, "A"), ("n", 1, ""), (None, 1, ""), ("o", 1, "")], key=str)


def test_counts_of_many_markers(spark):
    markers = [f"m{k}" for k in range(5000)]
    found = spark.range(4000).selectExpr("id % 50 as genome_id", "concat('m', id % 5000) as marker")
    counts = hits.hit_counts(found, spark.range(60).withColumnRenamed("id", "genome_id"), markers)
    assert counts.count() == 60 * 5000
    assert rows(counts.groupBy().agg(F.sum("n"), F.count_if(F.col("n") > 0))) == [(4000, 4000)]
    assert len(counts._jdf.queryExecution().analyzed().toString()) < 1_000_000


def test_lineages_of_long_lines_take_few_rounds(spark, monkeypatch):
    made = []
    monkeypatch.setattr(taxonomy, "stash", lambda df, name, f=taxonomy.stash: made.append(name) or f(df, name))
    chain = [(k, k - 1 if k > 1 else 1, "class" if k == 2 else "species" if k == 1000 else "no rank") for k in range(1, 1001)] + [(2000 + k, 2000 + (k + 1) % 37, "class" if k == 5 else "no rank") for k in range(37)] + [(3000, 2003, "species")]
    nodes = spark.createDataFrame(chain, "taxid long, parent long, rank string")
    known = nodes.selectExpr("taxid", "concat('n', taxid) as name")
    got = taxonomy.resolve_lineage(spark.createDataFrame([(1000,), (3,), (2007,), (3000,)], "taxid long"), nodes, known, ["class", "species"])
    assert rows(got) == sorted([(1000, "n2", "n1000"), (3, "n2", "NA"), (2007, "n2005", "NA"), (3000, "n2005", "n3000")], key=str)
    assert len(made) <= 12


def test_programs_that_fail_or_hang_are_rows(spark, tmp_path):
    script = f"""read x; if [ $x = bad ]; then echo oh no >&2; exit 4; fi; if [ $x = slow ]; then (sleep 30; touch {tmp_path}/child) & echo hm >&2; wait; fi; echo "$GROUP_K $x"; sed 's/^/got /'"""
    df = spark.createDataFrame([("a", "fine"), ("a", "more"), ("b", "bad"), ("c", "slow")], "k string, v string")
    schema = T.StructType().add("k", "string").add("line", "string")
    text, read = (lambda r: "\n".join(r["v"].sort_values()) + "\n"), (lambda out: pd.DataFrame({"line": out.splitlines()}))
    out, errors = groups.map_programs(df, ["k"], ["/bin/sh", "-c", script], text, read, schema, 1.5)
    assert rows(out) == [("a", "a fine"), ("a", "got more")]
    bad = {r.k: r.group_error for r in errors.collect()}
    assert set(bad) == {"b", "c"} and "ended with 4: oh no" in bad["b"] and "killed after 1.5 s: hm" in bad["c"]
    _, errors = groups.map_programs(df.where("k = 'a'"), ["k"], [f"{tmp_path}/absent"], text, read, schema)
    assert "absent" in errors.first().group_error
    assert not (tmp_path / "child").exists()


def test_totals_are_observed_in_one_write(spark):
    summary = spark.createDataFrame([("a", 12.0, "Yes"), ("b", 0.0, "No"), ("c", 10.0, "Yes")], "assembly_id string, perc_redund double, in_final_tree string")
    missing = spark.createDataFrame([("x",)], "id string")
    written, totals = report.run_totals(summary, missing)
    assert rows(written) == rows(summary) and rows(totals) == [(3, 2, 1, 2, 1)]
    assert rows(report.run_totals(summary.limit(0), missing.limit(0))[1]) == [(0, 0, 0, 0, 0)]


def test_clusters_need_a_shared_folder():
    from types import SimpleNamespace

    from cladeframe.scratch import shared_dir

    conf = SimpleNamespace(get=lambda key: None)
    context = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(SimpleNamespace(sparkContext=context))


def test_groups_are_cut_out_of_batches(spark):
    big = 2**60 + 1
    df = spark.range(3000).selectExpr("if(id % 500 = 7, null, id div 2 * 3) as k", f"if(id % 10 = 0, null, {big} + id) as v", "id % 3 = 0 as b")

    def fn(p):
        assert list(p.index) == list(range(len(p))) and str(p["b"].dtype) == "bool"
        if p["v"].isna().any():
            raise ValueError("a null")
        assert str(p["v"].dtype) == "int64"
        return pd.DataFrame({"total": [int(p["v"].max())], "n": [len(p)]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out, errors = groups.map_groups(df, ["k"], fn, T.StructType().add("k", "long").add("total", "long").add("n", "long"))
        got, failed = rows(out), rows(errors, "k")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for i in range(3000):
        want.setdefault(None if i % 500 == 7 else i // 2 * 3, []).append(None if i % 10 == 0 else big + i)
    assert got == sorted(((k, max(v), len(v)) for k, v in want.items() if None not in v), key=str)
    assert failed == sorted(((k,) for k, v in want.items() if None in v), key=str)
    assert "mapInPandas" in groups.map_groups.__code__.co_names  # a conversion for each batch, not for each group


def test_programs_of_a_task_run_side_by_side(spark, tmp_path):
    script = f"touch {tmp_path}/$GROUP_K; while [ ! -e {tmp_path}/$(cat) ]; do sleep 0.1; done; echo 1"
    read = lambda out: pd.DataFrame({"n": [int(out)]})
    df = spark.createDataFrame([("a", "b"), ("b", "a")], "k string, other string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # both in one task: each waits for the other
    try:
        out, errors = groups.map_programs(df, ["k"], ["/bin/sh", "-c", script], lambda p: p["other"].iloc[0], read, T.StructType().add("k", "string").add("n", "long"), 5.0)
        assert rows(out) == [("a", 1), ("b", 1)] and not errors.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hit_matrix_makes_no_row_for_a_zero(spark):
    counts = spark.createDataFrame([(1, "a.b", 2), (1, "x", 9), (2, "c", 1), (4, "x", 1)], "genome_id long, marker string, n long")
    genomes = spark.createDataFrame([(1,), (2,), (3,), (4,)], "genome_id long")
    wide = hits.hit_matrix(counts, ["a.b", "c"], None, genomes)
    assert wide.columns == ["genome_id", "a.b", "c"]
    assert rows(wide) == [(1, 2, 0), (2, 0, 1), (3, 0, 0), (4, 0, 0)]
    assert rows(hits.hit_matrix(counts, ["a.b", "c"])) == [(1, 2, 0), (2, 0, 1), (4, 0, 0)]
    assert "pivotfirst" not in wide._jdf.queryExecution().toString()


def test_small_groups_are_numbered_in_one_shuffle_and_large_ones_in_ranges(spark):
    df = spark.range(400).selectExpr("if(id < 300, if(id % 2 = 0, null, 'big'), concat('g', id % 30)) as g", "(id * 7919) % 1009 as o")
    want = sorted(rows(df), key=lambda r: (str(r[0]), r[1]))
    places, last = [], {}
    for g, o in want:
        last[g] = last.get(g, 0) + 1
        places.append((g, o, last[g]))
    for large in (10, 1000):
        got = sequences.numbers(df, ["g"], ["o"], large)
        assert rows(got) == sorted(places, key=str) and dict(got.dtypes)["n"] == "bigint"
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString() and "/ranges-" not in "".join(got.inputFiles())


def test_plans_without_sequences_write_no_store(spark, small):
    from cladeframe.registry import QUERIES

    stores = lambda: {t.name for t in spark.catalog.listTables()}
    before = stores()
    for name in ("w1_markers", "w1_summary", "w5_target_presence", "w5_viewer_and_missing"):
        assert QUERIES[name](spark, small).columns
    assert stores() == before
    QUERIES["w1_nucleotides"](spark, small)
    assert len(stores() - before) == 1  # the nucleotides', not the proteins' as well


def test_features_come_in_frames_of_bounded_size():
    batch = pd.DataFrame({"genome_id": [f"g{k}" for k in range(900)], "record": [GENBANK.partition("\n//")[0]] * 900})
    frames = list(readers.features_of(iter([batch, batch])))
    assert max(map(len, frames)) < readers.MOST_FEATURES + 10
    assert sum(map(len, frames)) == 2 * 900 * len(list(readers.cds_of(batch["record"][0])))
    assert list(pd.concat(frames)["genome_id"].drop_duplicates()) == list(batch["genome_id"])


def test_large_groups_are_found_in_full_slots(spark, monkeypatch):
    df = spark.range(60).selectExpr("if(id < 40, 'big', concat('g', id % 10)) as g", "(id * 7) % 61 as o")
    whole = rows(sequences.numbers(df, ["g"], ["o"], 1000))
    counted = []
    real = sequences.stash
    monkeypatch.setattr(sequences, "stash", lambda d, name: counted.append(name) or real(d, name))
    for slots, large, want in ((1, 30, ["large-groups", "ranges"]), (1, 50, ["large-groups"]), (sequences.SLOTS, 50, [])):
        monkeypatch.setattr(sequences, "SLOTS", slots)
        counted.clear()
        assert rows(sequences.numbers(df, ["g"], ["o"], large)) == whole
        assert counted == want


def test_stops_are_stripped_from_odd_sequences(spark):
    df = spark.createDataFrame([(s,) for s in ("**", "*a*ü*", "", "ab", None, "M*RR")], "seq string")
    assert [tuple(r) for r in sequences.strip_stops(df).collect()] == [("", 0), ("aü", 2), ("", 0), ("ab", 2), (None, None), ("MRR", 3)]


def test_names_of_plans_without_lengths_read_no_sequence(spark, small, monkeypatch):
    from cladeframe import registry

    seen = []
    real = registry.stash
    monkeypatch.setattr(registry, "stash", lambda d, name: seen.append((name, d.columns, d._jdf.queryExecution().executedPlan().toString())) or real(d, name))
    for name, lengths in (("w5_target_presence", False), ("j5_fetch_hit_seqs", False), ("w1_markers", True)):
        seen.clear()
        registry.QUERIES[name](spark, small)
        names = [(columns, plan) for stashed, columns, plan in seen if stashed == "gene-names"]
        assert len(names) == 1 and ("len" in names[0][0]) == lengths and ("l_returnflag" in names[0][1]) == lengths


def test_marker_tables_go_to_all_tasks_and_quality_waits(spark, monkeypatch):
    genomes = spark.createDataFrame([(g,) for g in "abcd"], "genome_id string")
    genes = spark.createDataFrame([(g, k, "A" * n, n) for g in "abcd" for k, n in enumerate((100, 10))], "genome_id string, gene_ord long, seq string, len int")
    found = spark.createDataFrame([(g, f"{g}_{k}", f"m{k}", 1.0, k) for g in "abcd" for k in (1, 2)], "genome_id string, gene_id string, marker string, evalue double, ord long")
    seen = {}
    real = pipelines.stash
    monkeypatch.setattr(pipelines, "stash", lambda d, name: seen.setdefault(name, d._jdf.queryExecution().executedPlan().toString()) and real(d, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pipelines.marker_sets(found, genes, genomes, ["m1", "m2", "m3"])
        assert rows(out["kept_markers"]) == [("m1", 4), ("m2", 4)] and rows(out["removed_markers"], "marker", "reason") == [("m3", "no hits")]
        assert out["sequences"].count() == 8 and out["quality"].count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in seen["filtered"] and "quality" not in seen


def test_stores_have_lengths_where_they_are_asked_for(spark, small):
    from cladeframe.registry import QUERIES

    raw = spark.createDataFrame([("a", 1, "M*AA"), ("a", 2, "M")], "genome_id string, gene_ord long, seq string")
    assert rows(pipelines.gene_store(raw, 2)) == [("a", 1, "MAA", 3), ("a", 2, "M", 1)]
    assert rows(pipelines.gene_store(raw, 2, lengths=False)) == [("a", 1, "MAA"), ("a", 2, "M")]
    before = {t.name for t in spark.catalog.listTables()}
    QUERIES["j5_fetch_hit_seqs"](spark, small)
    made, = {t.name for t in spark.catalog.listTables()} - before
    assert spark.table(made).columns == ["genome_id", "gene_ord", "seq"]


def test_tasks_put_a_bounded_number_of_bytes_in_place(spark, monkeypatch):
    from cladeframe.sources import named_files

    monkeypatch.setattr(named_files, "TASK", 20_000)
    pieces = spark.range(100).selectExpr("'one' as name", "0L as span", "id as nth", "2000L as size", "cast(repeat('x', 2000) as binary) as data").coalesce(1)
    parts = named_files.placed_pieces(pieces).rdd.glom().map(lambda p: [(r.start, len(r.data)) for r in p]).collect()
    assert sorted(x for p in parts for x in p) == [(2000 * k, 2000) for k in range(100)]
    assert len(parts) == 11 and max(sum(n for _, n in p) for p in parts) <= 2 * 20_000


def shuffle_files(spark, but=frozenset()):
    """Shuffle files other than some, given 20 s to be removed."""
    deadline = time.monotonic() + 20
    while True:
        found = {str(f) for f in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*")} - but
        if not but or not found or time.monotonic() > deadline:
            return found
        time.sleep(0.2)


def test_stores_lie_in_buckets_of_bounded_size_and_leave_no_shuffles(spark, monkeypatch):
    from cladeframe.sources import store

    monkeypatch.setattr(store, "BUCKET", 1_000_000, raising=False)
    seqs = spark.range(40_000).selectExpr("id % 7 as genome_id", "id as gene_ord", "repeat('ACGT', 250) as seq")
    before = shuffle_files(spark) | {""}
    made = store.write_store(seqs)
    files = made.inputFiles()
    assert 30 < len(files) < 50 and all(f.endswith(".zstd.parquet") for f in files)  # 40 MB; not one file for each of 8 shuffle partitions
    assert not shuffle_files(spark, before)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = hits.fetch_hit_seqs(seqs.where("gene_ord % 3 = 0").drop("seq"), made)
        assert "seq#" not in exchanged(got) and got.count() == 13_334 and made.count() == 40_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(store, "MOST", 20)
    assert store.bucket_count(seqs) == 20 and store.bucket_count(seqs.where("false")) == 8


@pytest.mark.parametrize("name", ["j5_fetch_hit_seqs", "j6_fetch_nucleotides"])
def test_fetched_hits_are_joined_once_and_leave_no_shuffles(spark, small, monkeypatch, name):
    from cladeframe import registry

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = []
    real = registry.genes_of
    monkeypatch.setattr(registry, "genes_of", lambda *a, **k: left.append(shuffle_files(spark, before)) or real(*a, **k))
    try:
        before = shuffle_files(spark) | {""}
        got = registry.QUERIES[name](spark, small)
        plan = got._jdf.queryExecution().executedPlan().toString()
        moved = exchanged(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not left[0]  # the sequences are written when the shuffles of hits and names are gone
    assert "seq#" not in moved and "l_partkey" not in moved
    assert plan.count("Exchange hashpartitioning") == 2  # hits by their place, names by theirs
