"""Scalar functions on read names, alignments and tolerant numbers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def read_name(raw: Column) -> Column:
    """The first word of a header line without its marks."""
    return F.regexp_replace(F.split(F.trim(raw), r"\s+")[0], r"^[@>]+", "")


def fragment_name(name: Column) -> Column:
    """A read name without its /1 or /2."""
    return F.regexp_replace(name, r"/[12]$", "")


def mate_of(header: Column) -> Column:
    """1 or 2 by the name's suffix, else by the second word (1:, 2:, 1, 2), else 0."""
    second = F.coalesce(F.get(F.split(F.trim(header), r"\s+"), F.lit(1)), F.lit(""))
    first = F.split(F.trim(header), r"\s+")[0]
    return F.when(first.endswith("/1"), 1).when(first.endswith("/2"), 2).when(second.rlike(r"^1(:|$)"), 1).when(second.rlike(r"^2(:|$)"), 2).otherwise(0)


def tagged(name: Column, mate: int) -> Column:
    return F.when(name.rlike(r"/[12]$"), name).otherwise(F.concat(name, F.lit(f"/{mate}")))


def cigar_steps(cigar: Column) -> Column:
    """array<struct<n:int,op:string>>; null if the text is not made of steps alone."""
    numbers, ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1)), F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    return F.when(cigar.rlike(r"^(\d+[MIDNSHP=X])+$"), F.zip_with(numbers, ops, lambda n, op: F.struct(n.cast("int").alias("n"), op.alias("op"))))


def strict_cigar_steps(cigar: Column) -> Column:
    """The same; text that is not made of steps alone fails the query."""
    refused = F.raise_error(F.concat(F.lit("not a CIGAR: "), F.coalesce(cigar, F.lit("null")))).cast("array<struct<n:int,op:string>>")
    return F.coalesce(cigar_steps(cigar), refused)


def cigar_sum(steps: Column, ops: str) -> Column:
    return F.aggregate(F.filter(steps, lambda s: s["op"].isin(*ops)), F.lit(0), lambda t, s: t + s["n"])


def columns_of(steps: Column) -> Column:
    return cigar_sum(steps, "M=XID")


def read_length(steps: Column) -> Column:
    return cigar_sum(steps, "M=XISH")


def reference_span(steps: Column) -> Column:
    return cigar_sum(steps, "M=XDN")


def strict_cigar(cigar: Column) -> Column:
    """The text itself; what is not made of steps alone, null too, fails the query."""
    refused = F.raise_error(F.concat(F.lit("not a CIGAR: "), F.coalesce(cigar, F.lit("null")))).cast("string")
    return F.when(F.coalesce(cigar.rlike(r"^(?:\d++[MIDNSHP=X])++$"), F.lit(False)), cigar).otherwise(refused)


def cigar_numbers(cigar: Column) -> dict[str, Column]:
    """columns, length, span, leading and trailing of a text that is made of steps alone: the numbers before some letters are summed
    where they stand, without an array of steps. Give it a column, as each number reads the text again."""
    of = lambda ops: F.aggregate(F.regexp_extract_all(cigar, F.lit(rf"(\d++)[{ops}]"), F.lit(1)), F.lit(0), lambda t, n: t + n.cast("int"))
    return {"columns": of("M=XID"), "length": of("M=XISH"), "span": of("M=XDN"), "leading": clip(cigar, "left"), "trailing": clip(cigar, "right")}


def clip(cigar: Column, end: str) -> Column:
    """Summed soft and hard clips at the left or right end."""
    run = F.regexp_extract(cigar, r"^((?:\d+[SH])+)" if end == "left" else r"((?:\d+[SH])+)$", 1)
    return F.aggregate(F.regexp_extract_all(run, F.lit(r"(\d+)"), F.lit(1)), F.lit(0), lambda t, n: t + n.cast("int"))


def five_prime(flag: Column, pos: Column, cigar: Column) -> Column:
    """The unclipped 5' end of an alignment at 1-based ``pos``."""
    span = reference_span(cigar_steps(cigar))
    return F.when(flag.bitwiseAND(F.lit(16)) != 0, pos + span - 1 + clip(cigar, "right")).otherwise(pos - clip(cigar, "left"))


def flagged(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) != 0


def whole_number(text: Column) -> Column:
    """An integer from text such as 7, 7.0 or 7e0; null for anything else."""
    x = text.try_cast("double")
    return F.when(x == F.floor(x), x.cast("long"))


def query_coverage(length: Column, qlen: Column) -> Column:
    return F.least(F.lit(1.0), F.try_divide(length * 3, qlen))


def identity_of_matched(matched: Column, nm: Column) -> Column:
    return F.try_divide(matched - nm, matched)


def sequence_digest(names: Column, lengths: Column) -> Column:
    """md5 of name:length in order."""
    return F.md5(F.array_join(F.zip_with(names, lengths, lambda n, size: F.concat_ws(":", n, size.cast("string"))), "\n"))


#: Length of the first chromosome in the builds of the human genome.
FIRST_CHROMOSOME = {248956422: "GRCh38", 249250621: "GRCh37", 248387328: "T2T-CHM13"}


def build_guess(length: Column) -> Column:
    out = F.lit("unknown")
    for size, name in FIRST_CHROMOSOME.items():
        out = F.when(length == size, name).otherwise(out)
    return F.when(length.isNull(), "no_chr1").otherwise(out)


def sequence_fingerprint(rows: Column) -> Column:
    """md5 of name:length in the order of the header; ``rows``: array of struct(ordinal, name, length)."""
    return F.md5(F.array_join(F.transform(F.array_sort(rows), lambda r: F.concat(r["name"], F.lit(":"), r["length"].cast("string"))), "\n"))


def digest_fingerprint(digests: Column) -> Column:
    """md5 of the sorted distinct digests of all sequences; null unless all have one. ``digests``: array with nulls."""
    blank = F.exists(digests, lambda d: F.coalesce(d, F.lit("")) == "")
    return F.when(~blank, F.md5(F.array_join(F.array_sort(F.array_distinct(digests)), "\n")))


def matched_identity(matched: Column, nm: Column) -> Column:
    return F.try_divide((matched - nm).cast("double"), matched.cast("double"))


def column_divergence(nm: Column, columns: Column) -> Column:
    return F.try_divide(nm.cast("double"), columns.cast("double"))


def block_identity(matches: Column, block: Column) -> Column:
    return F.try_divide(matches.cast("double"), block.cast("double"))


def header_gene(header: Column) -> Column:
    """The first token between pipes that names a gene, else unknown."""
    return F.coalesce(F.get(F.filter(F.split(header, r"\|"), lambda t: t.rlike("^clb[A-Za-z]$")), F.lit(0)), F.lit("unknown"))


def sample_of_file(path: Column, suffix: str) -> Column:
    """The file's name without one given suffix at its end."""
    return F.regexp_replace(F.regexp_extract(path, "[^/]+$", 0), "\\Q" + suffix + "\\E$", "")


def segment_of(flag: Column) -> Column:
    """1 or 2 by the segment bits; 0 if both or neither is set."""
    first, last = flag.bitwiseAND(64) != 0, flag.bitwiseAND(128) != 0
    return F.when(first & ~last, 1).when(last & ~first, 2).otherwise(0)


def allele_of(field: Column) -> Column:
    """The allele of a field written as locus(allele)."""
    return F.regexp_extract(field, r"^[^(]*\((.*)\)$", 1)


def header_fields(header: Column) -> Column:
    """k=v pairs between the pipes of a sequence header as a map."""
    pairs = F.filter(F.split(F.regexp_replace(header, r"^\S+\s*", ""), r"\|"), lambda p: p.contains("="))
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1), F.regexp_replace(p, "^[^=]*=", ""))))


#: Words that make an annotated gene an integrase or a transposase, and those of the narrower community rule.
INTEGRASE, TRANSPOSASE = ("integrase", "recombinase", "resolvase"), ("transposase", "insertion element", "is element")
MOBILITY = ("integrase", "site-specific recombinase", "phage recombinase")


def has_word(words: tuple[str, ...], *columns: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *columns))
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def bwa_evidence(programs: Column) -> Column:
    """yes, no_cl, not_mem or no by an array of struct(pn, cl) of a header's program lines."""
    mem = r"(^|\s)['\"]?([^\s]*/)?bwa(-mem2)?['\"]?\s+mem(\s|$)"
    is_mem = lambda p: F.coalesce(p["cl"].rlike(mem), F.lit(False))
    is_bwa = lambda p: F.lower(p["pn"]).isin("bwa", "bwa-mem2")
    silent = lambda p: is_bwa(p) & (F.coalesce(p["cl"], F.lit("")) == "")
    return F.when(F.exists(programs, is_mem), "yes").when(F.exists(programs, silent), "no_cl").when(F.exists(programs, is_bwa), "not_mem").otherwise("no")


def int_or_zero(text: Column) -> Column:
    """A whole number with optional sign and single underscores between digits, white space around it ignored; anything else, null too, is 0."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.coalesce(F.when(trimmed.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.regexp_replace(trimmed, "_", "").try_cast("long")), F.lit(0).cast("long"))


def float_or_zero(text: Column) -> Column:
    """A number with optional fraction and exponent, infinity or nan, white space around it ignored; anything else, null too, is 0."""
    trimmed = F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))
    plain = F.when(trimmed.rlike(r"^[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?$"), F.regexp_replace(trimmed, "_", "").try_cast("double"))
    named = F.when(trimmed.rlike(r"^[+-]?inf(inity)?$"), F.when(trimmed.startswith("-"), float("-inf")).otherwise(float("inf"))).when(trimmed.rlike(r"^[+-]?nan$"), float("nan"))
    return F.coalesce(plain, named, F.lit(0.0))


#: ``bwa mem`` as two words of a command line, the program also with a path or in quotes, and what follows; and the first -T in that, its
#: number written to it or as the next word.
BWA_MEM = r"""(?s)(?<!\S)['"]*+(?:\S*/)?bwa(?:-mem2)?['"]*+\s++mem(?!\S)(.*)$"""
MIN_SCORE = r"(?<!\S)-T(?:-?[0-9]++(?!\S)|(?!\S)\s*+\S*+)"


def bwa_min_score(command: Column) -> Column:
    """The -T of the first ``bwa mem`` of a command line, also inside a wrapper: its number, ``default`` without one, ``unparsed`` if what
    follows is no number; null if no ``bwa mem`` runs. Two searches of the text; it is not taken apart into words."""
    flag = F.regexp_extract(F.regexp_extract(command, BWA_MEM, 1), MIN_SCORE, 0)
    value = F.regexp_replace(flag, r"^-T\s*", "")
    score = F.when(flag == "", "default").when(value.rlike(r"^-?[0-9]+\z"), value).otherwise("unparsed")
    return F.when(command.rlike(BWA_MEM), score)
