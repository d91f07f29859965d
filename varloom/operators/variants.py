"""Variants, intervals and haplotype sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions import sequences as S
from varloom.operators import folds

#: Positions in one bin of a range join, about the length of an interval; in one of a range window, at least.
BIN, BINS = 256, 4096
#: What is kept of a background variant; lists of them sort in this order.
BACKGROUND = ("pos", "ref", "alt", "a1", "a2")


def variant_id() -> Column:
    return F.concat_ws("_", "chrom", "pos", "ref", "alt")


def parse_genotypes(rows: DataFrame, drop_hom_ref: bool = False) -> DataFrame:
    """First ALT, and both alleles of called diploid genotypes; others are left out."""
    gt = F.split("gt", r"[|/]")
    out = rows.filter(F.col("alt").isNotNull() & (F.col("alt") != ".")).withColumn("alt", F.split("alt", ",")[0])
    out = out.withColumn("_gt", gt).filter(F.size("_gt") == 2)
    out = out.withColumn("a1", F.expr("try_cast(_gt[0] as int)")).withColumn("a2", F.expr("try_cast(_gt[1] as int)")).drop("_gt", "gt").filter("a1 is not null and a2 is not null")
    return out.filter("not (a1 = 0 and a2 = 0)") if drop_hom_ref else out


def strict_genotype(gt: Column) -> Column:
    """struct(a1, a2) of a called diploid biallelic genotype, else null."""
    parts = F.split(gt, r"[|/]")
    alleles = F.transform(parts, lambda x: F.when(x.isin("0", "1"), x.cast("int")))
    return F.when((F.size(parts) == 2) & ~F.exists(alleles, lambda x: x.isNull()), F.struct(alleles[0].alias("a1"), alleles[1].alias("a2")))


def genotype_classes(rows: DataFrame) -> DataFrame:
    a1, a2 = F.col("a1"), F.col("a2")
    known = a1.isNotNull() & a2.isNotNull()
    flag = lambda c: F.coalesce(known & c, F.lit(False))
    return rows.withColumns({
        "non_reference": flag((a1 != 0) | (a2 != 0)), "hom_alt": flag((a1 == 1) & (a2 == 1)), "het": flag(a1 != a2), "hap1_alt": flag(a1 == 1), "hap2_alt": flag(a2 == 1),
    })


#: Bins of a next level are so many times as long; levels beyond the first that a region may have.
WIDER, LEVELS = 8, 12


def region_level(bin_size: int) -> Column:
    """The first level whose bins are as long as a region (start_, end_)."""
    length = F.col("end_") - F.col("start_")
    return sum((F.when(length > bin_size * WIDER**k, 1).otherwise(0) for k in range(LEVELS)), F.lit(0))


def overlap_join(rows: DataFrame, regions: DataFrame, bin_size: int = 4096) -> DataFrame:
    """Variants with each region (chrom, start_, end_) that they overlap: one row for each pair.

    A region goes to bins of about its length, so to two at most, however long it is; a variant to the bins it is in,
    on each level that some region has (these are asked for beforehand).  A pair meets in the bin where the later
    of the two begins, and there only.
    """
    v, r, same, size = _met(rows, regions, bin_size)
    meet = (F.col("_s") < F.col("end_")) & (F.col("_e") > F.col("start_")) & (F.col("_bin") == F.floor(F.greatest("_s", "start_") / size(F.col("_level"))))
    return v.join(r, same & meet).drop("_s", "_e", "_bin", "_level", "_rbin", "_rlevel", "_chrom")


def _met(rows: DataFrame, regions: DataFrame, bin_size: int) -> tuple[DataFrame, DataFrame, Column, Callable[[Column], Column]]:
    """Variants and regions in bins, where they meet, and the size of a level's bins."""
    size = lambda level: bin_size * F.pow(F.lit(WIDER), level).cast("long")
    bins = lambda s, e, by: F.explode(F.sequence(F.floor(s / by), F.floor((F.greatest(e, s + 1) - 1) / by)))
    r = regions.select(F.col("chrom").alias("_chrom"), "start_", "end_").filter("start_ is not null and end_ is not null").withColumn("_rlevel", region_level(bin_size))
    levels = sorted(x[0] for x in r.select("_rlevel").distinct().collect())  # LEVELS + 1 at most
    r = r.withColumn("_rbin", bins(F.col("start_"), F.col("end_"), size(F.col("_rlevel"))))
    v = rows.withColumns({"_s": F.col("pos") - 1, "_e": F.col("pos") - 1 + F.length("ref")})
    v = v.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>"))).withColumn("_bin", bins(F.col("_s"), F.col("_e"), size(F.col("_level"))))
    same = (F.col("chrom") == F.col("_chrom")) & (F.col("_level") == F.col("_rlevel")) & (F.col("_bin") == F.col("_rbin"))
    return v, r, same, size


def touching(rows: DataFrame, regions: DataFrame, bin_size: int = 4096) -> DataFrame:
    """The distinct ``rows`` that overlap a region, however many regions: no pairs are made.

    The regions of a bin are joined to stretches that don't overlap, of which a variant meets few.
    """
    v, r, same, size = _met(rows, regions, bin_size)
    bin_ = ["_chrom", "_rlevel", "_rbin"]
    # An empty region (end_ at or before start_) is overlapped by what holds its ends: kept as it is, not joined.
    whole = r.filter("end_ > start_").groupBy(*bin_, "start_").agg(F.max("end_").alias("end_"))
    before = Window.partitionBy(*bin_).orderBy("start_").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.when(F.max("end_").over(before) > F.col("start_"), 0).otherwise(1)
    upto = Window.partitionBy(*bin_).orderBy("start_").rowsBetween(Window.unboundedPreceding, 0)
    joined = whole.withColumn("_new", begins).withColumn("_no", F.sum("_new").over(upto)).groupBy(*bin_, "_no").agg(F.min("start_").alias("start_"), F.max("end_").alias("end_")).drop("_no")
    stretches = joined.unionByName(r.filter("end_ <= start_").distinct())
    found = v.join(stretches, same & (F.col("_s") < F.col("end_")) & (F.col("_e") > F.col("start_")), "left_semi")
    return found.select(*rows.columns).distinct()


def interval_sides(n: int) -> list[tuple[Column, Column, str]]:
    """Start, end and direction of a variant's two intervals."""
    end = F.col("pos") + F.length("ref") - 1
    return [(F.col("pos") - n - 1, end + 1, "upstream"), (F.col("pos") - 2, end + n, "downstream")]


def split_intervals(rows: DataFrame, n: int, least: int = 1) -> DataFrame:
    """Two rows for each variant, up- and downstream: start, end (half open, 0-based), direction, name.

    Variants whose upstream interval would start before the contig are left out.
    """
    if n < least:
        raise ValueError(f"flanks of {n} are shorter than {least}")
    both = F.array(*[F.struct(a.alias("start"), b.alias("end"), F.lit(d).alias("direction")) for a, b, d in interval_sides(n)])
    out = rows.filter(F.col("pos") - n - 1 >= 0).select("*", F.explode(both).alias("_i")).select("*", "_i.*").drop("_i")
    return out.withColumn("name", F.concat_ws("_", variant_id(), "direction"))


def periodic_window(start: Column, length: Column) -> Column:
    """The derived genome: ACGT over and over."""
    return F.substring(F.repeat(F.lit("ACGT"), ((length + 7) / 4).cast("int")), (start % 4 + 1).cast("int"), length.cast("int"))


def fetch_windows(intervals: DataFrame, genome: DataFrame, chunk: int, key: list[str]) -> DataFrame:
    """The genome of each interval (chrom, start, end) out of a chunked table, clipped at the contig's end.

    ``key`` names the columns that tell intervals apart.  Equi-join on (chrom, chunk_no); only the needed part of
    each chunk is moved.
    """
    pieces = intervals.withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor((F.greatest(F.col("end"), F.col("start") + 1) - 1) / chunk))))
    cut = F.expr(f"substring(seq, cast(greatest(start - chunk_no * {chunk}, 0) as int) + 1, cast(least(end - chunk_no * {chunk}, {chunk}) - greatest(start - chunk_no * {chunk}, 0) as int))")
    joined = pieces.join(genome, ["chrom", "chunk_no"]).select(*key, "chunk_no", cut.alias("part"))
    text = joined.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_no", "part"))), lambda x: x["part"]), "").alias("wt_ref"))
    return intervals.join(text, key)


#: Letters of a piece that windows are cut out of, without those that it is carried on by.
PIECE = 1024


def placed_windows(intervals: DataFrame, genome: DataFrame, chunk: int, longest: int | None = None) -> DataFrame:
    """``intervals`` (chrom, start, end; none starts before its contig) with ``wt_ref``, as ``fetch_windows`` has it: one join.

    Chunks are carried on by as many letters of those behind them as the ``longest`` interval needs and cut to pieces, so
    an interval meets the piece that it starts in, and nothing is put together again.  Without ``longest`` it is asked for.
    """
    if longest is None:
        longest = intervals.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 1
    more, piece = -(-max(longest - 1, 0) // chunk), min(PIECE, chunk)
    parts = genome.select("chrom", "chunk_no", "seq", F.explode(F.sequence(F.lit(0), F.lit(more))).alias("_k"))
    part = F.when(F.col("_k") == 0, F.col("seq")).otherwise(F.substring("seq", F.lit(1), F.lit(longest - 1) - (F.col("_k") - 1) * chunk))
    carried = parts.select("chrom", (F.col("chunk_no") - F.col("_k")).alias("_chunk"), F.struct("_k", part.alias("part")).alias("_p")).filter("_chunk >= 0")
    carried = carried.groupBy("chrom", "_chunk").agg(F.array_join(F.transform(F.sort_array(F.collect_list("_p")), lambda x: x["part"]), "").alias("_seq"))
    pieces = carried.select(F.col("chrom").alias("_chrom"), "_chunk", "_seq", F.explode(F.sequence(F.lit(0), F.lit(chunk - 1), F.lit(piece))).alias("_from"))
    pieces = pieces.select("_chrom", (F.col("_chunk") * chunk + F.col("_from")).alias("_at"), F.substring("_seq", F.col("_from") + 1, F.lit(piece + longest)).alias("_letters"))
    at = F.floor(F.col("start") / chunk) * chunk + F.floor(F.col("start") % chunk / piece) * piece
    found = intervals.join(pieces, (F.col("chrom") == F.col("_chrom")) & (at == F.col("_at")))
    cut = F.substring("_letters", (F.col("start") - F.col("_at") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    return found.withColumn("wt_ref", cut).drop("_chrom", "_at", "_letters")


def reference_pair(rows: DataFrame) -> DataFrame:
    """mut_ref: ALT put into wt_ref whatever stands there; null where the variant is out of the window."""
    return rows.withColumn("mut_ref", S.replace_at(F.col("wt_ref"), F.col("pos") - 1 - F.col("start"), F.col("ref"), F.col("alt")))


def background_join(intervals: DataFrame, rows: DataFrame, bin_size: int = BINS, longest: int | None = None) -> DataFrame:
    """Each interval with the other variants of its sample that start in it: background, sorted; an empty list without any.

    Intervals and variants meet in bins, and lists are made there: no pairs are shuffled.  An interval goes to the bin that it
    starts in, on the first level whose bins are as long as it is; a variant to its bin and the one before.
    ``longest`` is the longest interval; without it the levels that occur are asked for.
    """
    size = lambda level: bin_size * F.pow(F.lit(WIDER), level).cast("long")
    length = F.col("end") - F.col("start")
    level = sum((F.when(length > bin_size * WIDER**k, 1).otherwise(0) for k in range(LEVELS)), F.lit(0))
    if longest is None:
        levels = sorted(x[0] for x in intervals.select(level).distinct().collect())  # LEVELS + 1 at most
    else:
        levels = range(sum(longest > bin_size * WIDER**k for k in range(LEVELS)) + 1)
    key = lambda level, bin_: F.struct(level.alias("level"), bin_.alias("bin"))
    left = intervals.select("sample_id", "chrom", key(level, F.floor(F.col("start") / size(level))).alias("_bin"), F.struct(*intervals.columns).alias("i"))
    home = lambda k: F.floor((F.col("pos") - 1) / size(F.lit(k)))
    where = F.array(*[key(F.lit(k), home(k) - back) for k in levels for back in (0, 1)])
    right = rows.select("sample_id", "chrom", F.explode(where).alias("_bin"), F.struct(*BACKGROUND).alias("v"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_bin", F.concat_ws(":", "_bin.level", "_bin.bin"))
    return folds.backgrounds(both.repartition(*folds.GROUP).sortWithinPartitions(*folds.GROUP), left.schema["i"].dataType)


def background_texts(intervals: DataFrame, rows: DataFrame, names: list[str], bin_size: int = BINS, longest: int | None = None) -> DataFrame:
    """``background_join`` with a list as text (position, REF, >, ALT, with commas) and its length n: no list is made a column of structs.

    ``names`` are the columns of ``intervals`` that are kept, besides start and end; other columns are not shuffled.
    """
    size = lambda level: bin_size * F.pow(F.lit(WIDER), level).cast("long")
    length = F.col("end") - F.col("start")
    level = sum((F.when(length > bin_size * WIDER**k, 1).otherwise(0) for k in range(LEVELS)), F.lit(0))
    if longest is None:
        levels = sorted(x[0] for x in intervals.select(level).distinct().collect())  # LEVELS + 1 at most
    else:
        levels = range(sum(longest > bin_size * WIDER**k for k in range(LEVELS)) + 1)
    bin_ = lambda level, at: F.shiftleft(level.cast("long"), 48) + at  # noqa: E731 - a level's bins are fewer
    kept = list(dict.fromkeys(["sample_id", "chrom", *names, "pos", "ref", "alt", "start", "end"]))
    left = intervals.select(*kept, bin_(level, F.floor(F.col("start") / size(level))).alias("_bin"))
    # A variant goes to the bins of intervals that reach it: one, near a bin's start two.
    reach = lambda k: min(longest or bin_size * WIDER**k, bin_size * WIDER**k)
    where = F.flatten(F.array(*[F.sequence(*[bin_(F.lit(k), F.floor((F.col("pos") - back) / size(F.lit(k)))) for back in (reach(k), 1)]) for k in levels]))
    right = rows.select("sample_id", "chrom", "pos", "ref", "alt", F.explode(where).alias("_bin"))
    both = left.unionByName(right, allowMissingColumns=True)
    return folds.background_texts(both.repartition(*folds.GROUP).sortWithinPartitions(*folds.GROUP), names)


def into_bins(rows: DataFrame, before: int, after: int, longest: int | None = None) -> tuple[DataFrame, int, Column]:
    """rows in the bin (_bin) of their position and in those whose variants may see them, from ``before`` bases before
    a variant's position to ``after`` behind its REF's end; how far behind a position that is, and whether a row is in its own bin.

    A bin holds few positions, whatever the number of rows.  ``longest`` is the longest REF; without it, it is asked for.
    """
    if longest is None:
        longest = rows.agg(F.coalesce(F.max(F.length("ref")), F.lit(1))).first()[0]
    behind = after + longest - 1
    bin_size = max(BINS, 4 * (before + behind))
    seen = rows.withColumn("_bin", F.explode(F.sequence(F.floor((F.col("pos") - behind) / bin_size), F.floor((F.col("pos") + before) / bin_size))))
    return seen, behind, F.col("_bin") == F.floor(F.col("pos") / bin_size)


def with_neighbours(rows: DataFrame, before: int, after: int, longest: int | None = None) -> DataFrame:
    """rows with ``neighbours``, sorted: the variants of the sample from ``before`` bases before a variant's position to
    ``after`` behind its REF's end, itself among them, as far as ``longest`` (the longest REF) tells.

    One shuffle: a range window over the positions of a bin collects what each one sees.
    """
    seen, behind, home = into_bins(rows, before, after, longest)
    window = Window.partitionBy("sample_id", "chrom", "_bin").orderBy("pos").rangeBetween(-before, behind)
    return seen.withColumn("neighbours", F.sort_array(F.collect_list(F.struct(*BACKGROUND)).over(window))).filter(home).drop("_bin")


def split_with_background(rows: DataFrame, n: int, least: int = 1, longest: int | None = None) -> DataFrame:
    """split_intervals and background_join of the same variants, which then need one shuffle."""
    seen = split_intervals(with_neighbours(rows, n, n, longest), n, least)
    inside = lambda v: (v["pos"] - 1 >= F.col("start")) & (v["pos"] - 1 < F.col("end")) & ~((v["pos"] == F.col("pos")) & (v["ref"] == F.col("ref")) & (v["alt"] == F.col("alt")))
    return seen.withColumn("background", F.filter("neighbours", inside)).drop("neighbours")


def split_with_background_texts(rows: DataFrame, n: int, longest: int | None = None) -> DataFrame:
    """split_intervals of variants, and of each interval the other variants in it: n and background, as ``background_texts`` has them.

    One shuffle, of variants; texts are made in the task that has all that its intervals hold.
    """
    seen, _, home = into_bins(rows.select("sample_id", "chrom", "pos", "ref", "alt"), n, n, longest)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = seen.repartition(parts, *folds.GROUP).sortWithinPartitions(*folds.GROUP, "pos")
    spans = F.array(*[F.struct(a.alias("start"), b.alias("end"), F.lit(d).alias("direction")) for a, b, d in interval_sides(n)])
    none = F.array(F.struct(F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"), F.lit(None).cast("string").alias("direction")))
    # Each row as a variant, and as its intervals where it is at home.
    each = placed.select("*", F.explode(F.when(home & (F.col("pos") - n - 1 >= 0), F.concat(none, spans)).otherwise(none)).alias("_i")).select("*", "_i.*").drop("_i")
    return folds.background_texts(each, ["sample_id", "chrom", "pos", "ref", "alt", "direction"])


def _folded(rows: DataFrame, before: int, after: int, longest: int | None, windows: Callable[[Column], Column], more: Callable[[Column], dict[str, Column]], own: bool) -> DataFrame:
    """One shuffle, of variants: letters of windows are fetched behind it.

    Its partitions are as many as the session says: joined to fewer by their sizes they would be few for all that is made out of them.
    """
    seen, _, home = into_bins(rows, before, after, longest)
    placed = seen.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *folds.GROUP).sortWithinPartitions(*folds.GROUP, *BACKGROUND)
    placed = placed.withColumn("windows", windows(home))
    extra = more(F.col("windows"))
    return folds.fold_windows(placed.withColumns(extra), [*rows.columns, *extra], own)


def _window(start: Column, end: Column, direction: str, letters: Callable[[Column, Column], Column]) -> Column:
    return F.struct(F.lit(direction).alias("direction"), start.alias("start"), end.alias("end"), letters(start, end - start).alias("wt_ref"))


def folded_intervals(rows: DataFrame, n: int, letters: Callable[[Column, Column], Column], longest: int | None = None) -> DataFrame:
    """split_intervals with each interval's letters of the genome (``letters`` of start and length), and for both haplotypes
    the letters with the sample's other variants put in (_w1, _w2) and where the variant is in them (_at1, _at2).

    The same as folding the background of each interval, but what intervals share is folded once.  ``whole``: the
    variant is inside both of its intervals.
    """
    inside = lambda w: (F.col("pos") - 1 >= w["start"]) & (F.col("pos") - 1 - w["start"] + F.length("ref") <= F.length(w["wt_ref"]))
    both = F.array(*[_window(*side, letters) for side in interval_sides(n)])
    out = _folded(rows, n, n, longest, lambda home: F.when(home & (F.col("pos") - n - 1 >= 0), both), lambda w: {"whole": F.forall(w, inside)}, False)
    return out.withColumn("name", F.concat_ws("_", variant_id(), "direction"))


def of_haplotype(hap: int) -> Column:
    """The background that one haplotype carries."""
    carried = F.filter("background", lambda v: v[f"a{hap}"] != 0)
    return F.transform(carried, lambda v: F.struct(v["pos"].alias("pos"), v["ref"].alias("ref"), v["alt"].alias("alt"), v[f"a{hap}"].alias("allele")))


def six_sequences(rows: DataFrame) -> DataFrame:
    """hap1, hap2, reference: struct(mut, wt, wt_is_alias) for each interval with wt_ref and background.

    In steps, as a step's columns are used several times by the next: each fold stands in the plan once.
    """
    out = rows.withColumns({f"_b{hap}": of_haplotype(hap) for hap in (1, 2)})
    out = out.withColumns({f"_w{hap}": S.apply_background(F.col("wt_ref"), F.col("start"), F.col(f"_b{hap}")) for hap in (1, 2)} | {f"_at{hap}": S.center_offset(F.col("pos"), F.col("start"), F.col(f"_b{hap}")) for hap in (1, 2)})
    return six_of_folds(out.drop("_b1", "_b2"))


def six_of_folds(rows: DataFrame) -> DataFrame:
    """The same from what ``folded_intervals`` gives."""
    at = F.col("pos") - 1 - F.col("start")
    # Where mut_ref is not null, asked without its letters.
    out = reference_pair(rows.filter((at >= 0) & (at + F.length("ref") <= F.length("wt_ref")) & F.col("alt").isNotNull()))
    pairs = {f"hap{hap}": S.haplotype_pair(F.col(f"_w{hap}"), F.col(f"_at{hap}"), F.col("ref"), F.col("alt"), F.col(f"a{hap}")) for hap in (1, 2)}
    out = out.withColumns(pairs).drop(*[f"_{c}{hap}" for c in ("w", "at") for hap in (1, 2)])
    return out.withColumn("reference", F.struct(F.col("mut_ref").alias("mut"), F.col("wt_ref").alias("wt"), F.lit(False).alias("wt_is_alias")))


def six_of_haplotypes(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The same from haplotypes that were built beforehand (sample_id, name, hap1, hap2).

    REF is put back at the anchor for the wild type; rows are intervals with wt_ref, and those that the table
    does not have are left out (``missing_haplotypes`` gives them).
    """
    known = table.select(F.col("sample_id").alias("_sample"), F.col("name").alias("_name"), F.col("hap1").alias("_hap1"), F.col("hap2").alias("_hap2"))
    out = reference_pair(rows).join(known, (F.col("sample_id") == F.col("_sample")) & (F.col("name") == F.col("_name")))
    return _of_mutants(out).filter("mut_ref is not null").drop("_sample", "_name", "_hap1", "_hap2")


def _of_mutants(rows: DataFrame) -> DataFrame:
    """hap1, hap2, reference out of _hap1 and _hap2, the wild types restored."""
    out = rows
    for hap in (1, 2):
        mut = F.col(f"_hap{hap}")
        wt = S.restore_wild_type(mut, F.col("direction"), F.col("ref"), F.col("alt"))
        carried = F.col(f"a{hap}") == 1
        out = out.withColumn(f"hap{hap}", F.struct(mut.alias("mut"), F.when(carried, wt).otherwise(mut).alias("wt"), (~F.coalesce(carried, F.lit(False))).alias("wt_is_alias")))
    return out.withColumn("reference", F.struct(F.col("mut_ref").alias("mut"), F.col("wt_ref").alias("wt"), F.lit(False).alias("wt_is_alias")))


def six_of_built(rows: DataFrame, variants: DataFrame, n: int, letters: Callable[[Column, Column], Column], longest: int | None = None) -> DataFrame:
    """``six_of_haplotypes`` with the table that ``six_of_folds`` of ``variants`` gives, without a look-up of letters.

    Intervals (``rows``, one row each) meet the variants that they are named after, and only haplotypes that are asked for are built: keys alone are shuffled.
    """
    key = ["sample_id", "chrom", "pos", "ref", "alt"]
    asked = rows.groupBy(*key).agg(F.collect_set("direction").alias("_asked"))
    built = six_of_folds(folded_intervals(variants.join(asked, key, "left"), n, letters, longest)).filter(F.array_contains("_asked", F.col("direction")))
    return _of_mutants(built.withColumns({f"_hap{hap}": F.col(f"hap{hap}.mut") for hap in (1, 2)})).drop("_asked", "_hap1", "_hap2")


def missing_haplotypes(rows: DataFrame, table: DataFrame) -> DataFrame:
    return rows.select("sample_id", "name").join(table.select("sample_id", "name"), ["sample_id", "name"], "left_anti")


def rejected_intervals(rows: DataFrame, n: int) -> DataFrame:
    """The variants that split_intervals leaves out: those too near to the contig's start."""
    return rows.filter(F.col("pos") - n - 1 < 0)


def both_directions(rows: DataFrame) -> DataFrame:
    """Only variants whose sequences could be built in both directions; where ``whole`` tells, no rows meet for that."""
    if "whole" in rows.columns:
        return rows.filter("whole")
    key = ["sample_id", "chrom", "pos", "ref", "alt"]
    whole = rows.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n = 2").drop("_n")
    return rows.join(whole, key, "left_semi")


def flatten(rows: DataFrame) -> DataFrame:
    """One row per sequence, {direction}_{hap}_{mut|wt}; a wild type that is its mutant's alias is left out."""
    entries = [(h, k) for h in ("hap1", "hap2", "reference") for k in ("mut", "wt")]
    name = {"reference": "ref"}
    every = F.array(*[F.struct(F.concat(F.col("direction"), F.lit(f"_{name.get(h, h)}_{k}")).alias("seq_name"), F.col(f"{h}.{k}").alias("seq"), (~F.col(f"{h}.wt_is_alias") if k == "wt" else F.lit(True)).alias("keep")) for h, k in entries])
    return rows.select("sample_id", variant_id().alias("variant_id"), F.explode(F.filter(every, lambda x: x["keep"])).alias("x")).select("sample_id", "variant_id", "x.seq_name", "x.seq")


def legacy_haplotypes(rows: DataFrame, half: int, letters: Callable[[Column, Column], Column], longest: int | None = None) -> DataFrame:
    """hap1 and hap2 of centred windows: all variants of the sample in the window, the center's too, are folded in."""
    left, right = F.col("pos") - half, F.col("pos") + F.length("ref") - 1 + half
    own = lambda home: F.when(home & (left >= 1), F.array(_window(left - 1, right, "", letters)))
    out = _folded(rows, half, half, longest, own, lambda w: {}, True)
    return out.select(*rows.columns, F.col("_w1").alias("hap1"), F.col("_w2").alias("hap2"))


def centred_windows(rows: DataFrame, half: int) -> DataFrame:
    """left, right (1-based, both in) around each variant; those left of the contig are left out."""
    return rows.withColumns({"left": F.col("pos") - half, "right": F.col("pos") + F.length("ref") - 1 + half}).filter("left >= 1")
