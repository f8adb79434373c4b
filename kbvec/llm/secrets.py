r"""Secret scans: fixed patterns, and the Shannon entropy of sliding windows over candidate strings.

Base findings are the leftmost non-overlapping matches of three patterns (``KINDS``), of which those that are too
short are dropped. The method adds candidates: runs of letters, digits and ``+/_=-`` that hold a digit and a letter.
A window of fixed width slides over a candidate; the counts of its characters are kept, and a step changes two of them,
that of the character that enters and that of the one that leaves, and the entropy with them. A candidate is reported when the largest entropy of its windows reaches
the bound of its character class (hexadecimal, letters of one case with digits, or all); a path in lower case is
reported when one of its segments is. Candidates that the allow-list matches are not reported; base findings stay.

All of it is DataFrame functions, row by row: there is no shuffle. Positions come from the lengths of what stands
between the matches, in code points, end exclusive. Time is linear in a text, its matches and its candidates.

Defined cases: a null text counts as empty; texts and candidates of any length are scanned whole; repeated rows and
null ids give a row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order in which kinds are listed, and the least length of a finding.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32
KINDS = ("assign", "access", "hex", "entropy")

_RUN = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{_RUN}])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[{_RUN}]{{20,}}"
WINDOW = 20
#: Bits of entropy at which a candidate is reported, by character class, in the order in which classes are tried.
CLASSES = ((r"^[0-9a-fA-F]+$", 3.2), (r"^([a-z0-9_=-]+|[A-Z0-9_=-]+)$", 3.6), (r"", 3.8))
#: Strings that look random and are not secret: examples, runs of the alphabet or of digits, UUIDs.
ALLOWED = (r"(?i:example|placeholder|changeme|xxxx|test_?key|0123456789|abcdefghij)"
           r"|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
#: Paths in lower case are judged by their segments.
PATH, NO_PATH = r"^[a-z-]+/[a-z0-9_/-]*[a-z0-9_-]$", "//"
#: Matches that are laid out together, and characters of a candidate that are.
RUN, PIECE = 256, 4_096

_SPANS = "array<struct<start:bigint,kind:int,end:bigint,hit:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once although the body's lambdas use it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """start, place of the kind in ``KINDS``, end and string of every match of ``pattern``.

    Matches are laid end to end in runs of ``RUN``: appending to one list of them all would copy it for every match.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(hits, F.split(text, pattern, -1), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))

    def length(p):
        return (F.char_length(p["gap"]) + F.coalesce(F.char_length(p["hit"]), F.lit(0))).cast("bigint")

    def step(s, p):
        begin = s["at"] + F.char_length(p["gap"])
        end = s["at"] + length(p)
        span = F.struct(begin.cast("bigint").alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                        end.cast("bigint").alias("end"), p["hit"].alias("hit"))
        # The last gap has no match behind it.
        return F.struct(end.cast("bigint").alias("at"),
                        F.when(p["hit"].isNull(), s["spans"]).otherwise(F.concat(s["spans"], F.array(span))).alias("spans"))

    def laid(run, at):
        start = F.struct(at.alias("at"), F.array().cast(_SPANS).alias("spans"))
        return F.aggregate(run, start, step, lambda s: s["spans"])

    def begins(runs):
        """Where each run begins."""
        zero = F.lit(0).cast("bigint")
        sums = F.transform(runs, lambda run: F.aggregate(run, zero, lambda n, p: n + length(p)))
        start = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("all"))
        return F.aggregate(sums, start, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")),
                           lambda s: s["all"])

    def cut(p):
        return F.transform(F.sequence(F.lit(0), (F.size(p) - 1).cast("int"), F.lit(RUN)), lambda i: F.slice(p, i + 1, RUN))

    found = _let(_let(pairs, cut), lambda runs: F.flatten(F.zip_with(runs, begins(runs), laid)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def window_entropy(string: Column, width: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits) of the windows of ``width`` characters of a string; -1 if it is shorter.

    The string's characters are those of a candidate. The state is the counts of the characters in the window, twelve
    to a number, and the sum of n * log2(n) over them; a step adds one to the count of the character that enters and
    takes one from that of the one that leaves, and changes two terms of the sum.
    """
    term = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(width + 2)])
    first, per, bits = ord("+"), 12, 5
    numbers = (ord("z") - first) // per + 1
    where = F.transform(F.split(string, ""), lambda c: F.struct(
        F.floor((F.ascii(c) - first) / per).cast("int").alias("number"), (F.pmod(F.ascii(c) - first, F.lit(per)) * bits).alias("shift")))

    def steps(chars):
        gone = F.concat(F.array_repeat(F.lit(None).cast("struct<number:int,shift:int>"), width), chars)
        moves = F.zip_with(chars, F.slice(gone, F.lit(1), F.size(chars)), lambda c, g: F.struct(c.alias("enters"), g.alias("leaves")))
        return F.transform(moves, lambda m, i: F.struct(m["enters"].alias("enters"), m["leaves"].alias("leaves"), (i >= width - 1).alias("full")))

    def one(char):
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), char["shift"])

    def count(s, char):
        return F.call_function("shiftright", F.get(s["counts"], char["number"]), char["shift"]).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

    def step(s, m):
        enters, leaves = m["enters"], m["leaves"]
        n, k = count(s, enters), count(s, leaves)
        counts = F.transform(s["counts"], lambda x, i: x + F.when(i == enters["number"], one(enters)).otherwise(F.lit(0))
                             - F.when(i == leaves["number"], one(leaves)).otherwise(F.lit(0)))
        change = (F.get(term, n + 1) - F.get(term, n)) + F.when(
            leaves.isNotNull(), F.get(term, k - 1) - F.get(term, k)).otherwise(0.0)
        # The one character for the other: nothing changes.
        total = s["sum"] + F.when(enters == leaves, 0.0).otherwise(change)
        here = F.when(m["full"], math.log2(width) - total / width).otherwise(F.lit(-1.0))
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(s["best"], here).alias("best"))

    start = F.struct(F.array_repeat(F.lit(0).cast("bigint"), numbers).alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1.0).alias("best"))
    return F.aggregate(_let(where, steps), start, step, lambda s: s["best"])


def _reaches(string: Column) -> Column:
    """True when the entropy of ``string`` reaches the bound of its class.

    A long string is looked at in pieces that share all but one character of a window, until one reaches the bound.
    """
    bound = F.when(F.lit(False), 0.0)
    for pattern, bits in CLASSES:
        bound = bound.when(string.rlike(pattern), bits)
    pieces = F.regexp_extract_all(string, F.lit(f"(?=(.{{1,{PIECE + WINDOW - 1}}})).{{1,{PIECE}}}"), F.lit(1))
    return _let(bound, lambda least: F.exists(pieces, lambda piece: window_entropy(piece) >= least))


def _random(span: Column) -> Column:
    """True for a candidate that the allow-list does not match and that reaches its bound, or of a path any segment."""
    hit = span["hit"]
    return ~hit.rlike(ALLOWED) & F.when(
        hit.rlike(PATH) & ~F.contains(hit, F.lit(NO_PATH)), F.exists(F.split(hit, "/"), _reaches)).otherwise(_reaches(hit))


def _long_enough(span: Column) -> Column:
    value = F.when(span["kind"] == 0, F.regexp_extract(span["hit"], ASSIGN, 2)).otherwise(span["hit"])
    least = F.when(span["kind"] == 0, ASSIGN_CHARS).when(span["kind"] == 1, ACCESS_CHARS).otherwise(HEX_CHARS)
    return F.char_length(value) >= least


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and findings (start, kind, end, hit), base and added ones, by start and then by kind."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    # A run of 32 or more finds the same as all runs of which the shorter are dropped, and looks at fewer.
    patterns = (("assign", ASSIGN), ("access", ACCESS), ("hex", rf"[0-9a-f]{{{HEX_CHARS},}}"), ("entropy", CANDIDATE))
    found = rows.select("doc_id", *[_spans(text, kind, pattern).alias(kind) for kind, pattern in patterns])
    base = F.filter(F.concat("assign", "access", "hex"), _long_enough)
    added = F.filter("entropy", _random)
    return found.select("doc_id", F.array_sort(F.concat(base, added)).alias("findings"))


def digest(docs: DataFrame) -> DataFrame:
    """One row for each document: counts of base findings, a checksum of them, and all findings as text."""
    found = find_secrets(docs).withColumn("base", F.filter("findings", lambda s: s["kind"] < 3))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                        _written(F.col("findings")).alias("spans"))
