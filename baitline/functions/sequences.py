"""Column functions on sequences, names and counts; JVM expressions only."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: residues of the standard code over TCAGN^3; an ambiguous codon keeps its residue where all expansions agree.
CODONS = "FFLLXSSSSSYY**XCC*WXXXXXXLLLLLPPPPPHHQQXRRRRRXXXXXIIIMXTTTTTNNKKXSSRRXXXXXXVVVVVAAAAADDEEXGGGGGXXXXXXXXXXXXXXXXXXXXXXXXXXXXXX"


def gene_of(name: Column) -> Column:
    """Text after the last hyphen; dots belong to the gene."""
    return F.regexp_extract(name, r"([^-]*)$", 1)


def taxon_of(name: Column) -> Column:
    """Text before the last hyphen."""
    return F.regexp_extract(name, r"^(.*)-[^-]*$", 1)


def read_id(raw: Column) -> Column:
    """First word of a read's name without its mate suffix /1 or /2."""
    return F.regexp_replace(F.substring_index(raw, " ", 1), "/[12]$", "")


def good_header(name: Column) -> Column:
    """Taxon-gene, without quotes."""
    return name.rlike("^.+-[^-]+$") & ~name.contains("'") & ~name.contains('"')


def pad_codons(seq: Column) -> Column:
    """seq with N added up to a multiple of three."""
    return F.concat(seq, F.repeat(F.lit("N"), (F.lit(3) - F.length(seq) % 3) % 3))


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTN", "TGCAN")


#: Fixed value: the codons of a stop; in-frame ones are sought by regular expressions, which scan a sequence once.
STOP = "(?:TAA|TAG|TGA)"


def translate(seq: Column, table: str = CODONS) -> Column:
    """Residues of the whole codons of seq; a codon of three gaps stays a gap, other letters give X.

    The sequence is cut into codons once. A codon is found in one text of all codons, those without N first; its place
    leads to its residue.
    """
    known = {"".join(c): table[i] for i, c in enumerate(product("TCAGN", repeat=3))} | {"---": "-"}
    codons = sorted(known, key=lambda c: "N" in c)
    at = F.array(*(F.lit(known[codons[(i - 1) // 4]] if i % 4 == 1 else "X") for i in range(4 * len(codons))))
    residue = lambda c: F.get(at, F.instr(F.lit(",".join(codons)), c))
    return F.coalesce(F.array_join(F.transform(F.regexp_extract_all(seq, F.lit("(?s)..."), F.lit(0)), residue), ""), F.lit(""))


def stop_codons(bases: Column) -> Column:
    """Number of stops among the whole codons of bases; as stops(translate(bases)), without the residues."""
    return F.coalesce(F.regexp_count(bases, F.lit(rf"(?s)\G(?:...)*?{STOP}")), F.lit(0)).cast("long")


def ends_in_stop(bases: Column) -> Column:
    """Whether bases are whole codons, the last of them a stop."""
    return F.coalesce(bases.rlike(rf"(?s)\A(?:...)*{STOP}\z"), F.lit(False))


def stops_inside(bases: Column, terminal_is_fine: bool = True) -> Column:
    """Whether bases, padded to whole codons, have internal stops."""
    return F.coalesce(bases.rlike(rf"(?s)\A(?:...)*?{STOP}" + ("." if terminal_is_fine else "")), F.lit(False))


def frame(seq: Column, offset: int) -> Column:
    """Whole codons of seq from offset 0, 1 or 2 on."""
    rest = F.substr(seq, F.lit(offset + 1), F.length(seq))
    return F.substr(rest, F.lit(1), (F.floor(F.length(rest) / 3) * 3).cast("int"))


def stops(protein: Column) -> Column:
    return F.length(F.regexp_replace(protein, r"[^*]", "")).cast("long")


def internal_stops(protein: Column, terminal_is_fine: bool = True) -> Column:
    """Stops that count against a hit; a single one at the end may be allowed."""
    n = stops(protein)
    return F.when(protein.endswith("*"), n - 1).otherwise(n) if terminal_is_fine else n


def letters_of(text: Column) -> Column:
    return F.filter(F.array_sort(F.array_distinct(F.split(text, ""))), lambda c: c != "")


def entropy(text: Column, letters: Column | None = None) -> Column:
    """Shannon entropy (bits) of the letters of text; letters: all that may occur, where they are known already."""
    n = F.length(text)
    shares = F.transform(letters_of(text) if letters is None else letters, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.when(n > 0, -F.aggregate(shares, F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def low_complexity(seq: Column, window: int = 100, threshold: float = 1.5) -> Column:
    """Whether any window has an entropy of at most threshold; a shorter sequence is one window."""
    last = F.greatest(F.length(seq) - window, F.lit(0))
    windows = F.transform(F.sequence(F.lit(0), last), lambda k: F.substr(seq, k + 1, F.lit(window)))
    low = lambda letters: F.exists(windows, lambda w: entropy(w, letters) <= threshold)
    return F.get(F.transform(F.array(letters_of(seq)), low), F.lit(0))


def contig_depth(contig: Column) -> Column:
    """Number after the last underscore of an assembler's contig name."""
    return F.element_at(F.split(contig, "_"), -1).cast("double")


def sample_of_file(path: Column) -> Column:
    """Name of a read file up to its first underscore."""
    return F.substring_index(F.substring_index(path, "/", -1), "_", 1)


def stem(name: Column) -> Column:
    """File name without suffix and without the marks of derived files."""
    return F.regexp_replace(F.regexp_replace(F.substring_index(name, "/", -1), r"\.[^.]*$", ""), "_(supercontig|introns|paralogs)$", "")


def without_gaps(seq: Column) -> Column:
    return F.replace(seq, F.lit("-"), F.lit(""))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded half to even; 0 where whole is 0."""
    return F.bround(F.coalesce(F.lit(100.0) * part / F.when(whole != 0, whole), F.lit(0.0)), digits)
