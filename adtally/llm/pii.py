r"""Personal data: regular expressions propose, checksums confirm, context words weigh.

Everything is a column expression over the row's whole text. A kind's matches come from
``\G.*?(?:pattern)``: each piece holds the gap since the last match and the match, so
places are running sums of piece lengths, and a search that finds no more ends at once.
Patterns hold no nested backtracking (possessive runs), and one that opens with a run starts
only where the run begins or the last match ended, so long texts take linear time and no
deep stack.

Kinds: email, ip, card (Luhn) and phone make up the base, which the score never drops.
Three more are added: iban (mod-97), and two that need a context word nearby: ssn and
routing, a bank's number of nine digits with a weighted checksum.

Only the head of an iban is consumed. What follows is looked at from each head anew, and
where blanks part the groups, every cut at a group's end is tried: the next word may look
like one more group, and an account number may begin within another proposal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import bound_to

#: Context words count within so many characters before or after a span.
NEAR = 40
THRESHOLD = 0.5

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn check."""
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (upper case, no blanks) has remainder 1 by ISO 7064."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def add(rest, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


#: Characters of a chunk: a place in a text is found by its chunk, not by reading from the start.
CHUNK = 1024


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _part(chunks: Column, start: Column, length: Column) -> Column:
    """``length`` characters of a text from ``start`` on, or as many as there are."""
    first = (start / CHUNK).cast("int")
    n = ((start + length) / CHUNK).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(chunks, first + 1, n), ""), start - first * CHUNK + 1, length)


# The shortest iban has 15 characters, the longest 34 (8 more with blanks).
_IBAN_HEAD, _IBAN_REACH, _IBAN_CUTS = 4, 48, (39, 34, 29, 24, 19)
_IBAN_REST = r"(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"


def _iban_at(chunks: Column, head_end: Column) -> Column:
    """The longest cut with the right remainder of what is proposed from a head on, else all of it."""
    near = _part(chunks, head_end - _IBAN_HEAD, F.lit(_IBAN_REACH))

    def cut(full: Column) -> Column:
        ends = F.filter(F.array(*[F.lit(n) for n in _IBAN_CUTS]), lambda n: full.contains(" ") & (n < F.length(full)))
        cuts = F.concat(F.array(full), F.transform(ends, lambda n: F.left(full, n)))
        return F.coalesce(F.get(F.filter(cuts, lambda c: mod97(F.replace(c, F.lit(" "), F.lit("")))), F.lit(0)), full)

    return bound_to(F.regexp_extract(near, rf"^[A-Z]{{2}}[0-9]{{2}}{_IBAN_REST}", 0), cut)


def weighted371(digits: Column) -> Column:
    """Whether nine ASCII digits, weighted 3, 7 and 1 in turn, sum to a multiple of ten."""
    add = lambda total, i: total + F.substring(digits, i, F.lit(1)).cast("int") * F.element_at(
        F.array(*map(F.lit, (1, 3, 7))), i % 3 + 1
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(0), add) % 10 == 0


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: Holds for every text with a match, and is cheap to test.
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool
    #: If the pattern is but a head: the match, from the text's chunks and the head's end.
    match_at: Callable[[Column, Column], Column] | None = None


# The base patterns (runs written possessively), kinds in the order of output.
KINDS = (
    Kind(
        "email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: t.contains("@"), lambda m: F.lit(True), 0.8, "mail|contact|write|address", True,
    ),
    Kind(
        "ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        0.6, "ip|host|server|address|login", True,
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?+[0-9])++",
        lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        lambda m: bound_to(_digits(m), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)),
        0.7, "card|visa|master|credit|debit|pay", True,
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: t.contains("+"), lambda m: F.length(_digits(m)).between(9, 15), 0.6, "phone|call|tel|mobile|fax", True,
    ),
    Kind(
        "iban", rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?={_IBAN_REST})",
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
        lambda m: mod97(F.replace(m, F.lit(" "), F.lit(""))), 0.7, "iban|account|bank|transfer", False, _iban_at,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, "ssn|social|security|insured", False,
    ),
    Kind(
        "routing", r"(?<![0-9.+-])[0-9]{9}(?![0-9-])",
        lambda t: t.rlike("[0-9]{9}"), lambda m: (m != "000000000") & weighted371(m), 0.3, "routing|aba|transit", False,
    ),
)


def _pieces(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?(?:{kind.pattern})"), F.lit(0))
    return F.when(kind.hint(text), found).otherwise(F.array().cast("array<string>"))


def _starts(lengths: Column, block: int = 512) -> Column:
    """Running sums before each element; blocks keep the copying of arrays short."""

    def small(values: Column) -> Column:
        first = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
        add = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out"))
        return F.aggregate(values, first, add)["out"]

    def joined(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
        return F.flatten(F.zip_with(blocks, small(sums), lambda b, s: F.transform(small(b), lambda x: x + s)))

    cut = F.transform(
        F.sequence(F.lit(0), ((F.size(lengths) - 1) / block).cast("int")),
        lambda k: F.slice(lengths, k * block + 1, F.lit(block)),
    )
    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(bound_to(cut, joined))


def _judged(text: Column, pieces: Column, kind: Kind) -> Column:
    """For each piece: its match, the places, the score, and whether it is confirmed."""

    def with_starts(at: Column) -> Column:
        starts, chunks = at["starts"], at["chunks"]

        def one(piece: Column, at: Column) -> Column:
            if kind.match_at is not None:
                start = at + F.length(piece) - _IBAN_HEAD
                return bound_to(kind.match_at(chunks, at + F.length(piece)), lambda m: weighed(m, start, start + F.length(m)))
            match = F.regexp_extract(piece, rf"(?:{kind.pattern})\z", 0)
            return bound_to(match, lambda m: weighed(m, at + F.length(piece) - F.length(m), at + F.length(piece)))

        def weighed(m: Column, start: Column, end: Column) -> Column:
            before = F.least(start, F.lit(NEAR))
            around = F.concat_ws(" ", _part(chunks, start - before, before), _part(chunks, end, F.lit(NEAR)))
            near = F.lower(around).rlike(rf"(?<!\p{{L}})(?:{kind.context})")
            score = kind.score + F.when(near, 0.3).otherwise(0.0)
            confirmed = kind.valid(m) if kind.base else kind.valid(m) & (score >= THRESHOLD)
            return F.struct(
                F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"),
                score.alias("score"), m.alias("text"), confirmed.alias("confirmed"),
            )

        return F.zip_with(pieces, starts, one)

    starts = bound_to(F.transform(pieces, lambda p: F.length(p)), lambda lengths: _starts(lengths))
    chunks = F.when(F.size(pieces) > 0, _chunks(text)).otherwise(F.array().cast("array<string>"))
    return bound_to(F.struct(starts.alias("starts"), chunks.alias("chunks")), with_starts)


def _spans_of(text: Column, kind: Kind) -> Column:
    """array<struct<kind, start, end, score, text>> of one kind, in order of place."""
    judged = bound_to(_pieces(text, kind), lambda pieces: _judged(text, pieces, kind))
    found = F.transform(
        F.filter(judged, lambda m: m["confirmed"]),
        lambda m: F.struct(*[m[c].alias(c) for c in ("kind", "start", "end", "score", "text")]),
    )
    return found if kind.match_at is None else bound_to(found, _apart)


def _apart(found: Column) -> Column:
    """Spans in order of place, without those that begin within one kept before."""
    first = F.struct(F.lit(0).alias("end"), F.slice(found, 1, 0).alias("out"))
    add = lambda a, m: F.when(m["start"] < a["end"], a).otherwise(
        F.struct(m["end"].alias("end"), F.concat(a["out"], F.array(m)).alias("out"))
    )
    return F.aggregate(found, first, add)["out"]


def spans(text: Column) -> Column:
    """All spans of a whole text, by kind in the order of KINDS, then by start.

    Places are in code points, ends exclusive. A null text has none.
    """
    text = F.coalesce(text, F.lit(""))
    return F.concat(*[_spans_of(text, k) for k in KINDS])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for each row; null ids and repeated rows stay; an empty table gives none."""
    return docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col)).alias("spans"))


def _without(text: Column, kind: Kind) -> Column:
    """The text with each confirmed span of one kind replaced by the kind's name in brackets."""

    def join(pieces: Column) -> Column:
        total = F.aggregate(pieces, F.lit(0), lambda a, p: a + F.length(p))
        kept = F.zip_with(
            pieces, _judged(text, pieces, kind),
            lambda p, m: F.when(
                m["confirmed"],
                F.concat(F.left(p, F.length(p) - F.length(m["text"])), F.lit(f"[{kind.name.upper()}]")),
            ).otherwise(p),
        )
        return F.concat(F.array_join(kept, ""), F.substring(text, total + 1, F.length(text)))

    def around(x: Column) -> Column:
        found, chunks = x["found"], x["chunks"]
        ends = F.concat(F.array(F.lit(0)), F.transform(found, lambda m: m["end"]))
        kept = F.zip_with(
            ends, found, lambda end, m: F.concat(_part(chunks, end, m["start"] - end), F.lit(f"[{kind.name.upper()}]"))
        )  # null at the last end, which array_join leaves out
        return F.concat(F.array_join(kept, ""), F.substring(text, F.element_at(ends, -1) + 1, F.length(text)))

    if kind.match_at is None:
        masked = bound_to(_pieces(text, kind), join)
    else:
        masked = bound_to(F.struct(_spans_of(text, kind).alias("found"), _chunks(text).alias("chunks")), around)
    return F.when(kind.hint(text), masked).otherwise(text)


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span in ``text_col`` replaced by its kind in brackets.

    Null texts stay null, rows and columns stay as they are. Kinds are masked one after the
    other, those with a checksum first, so where spans overlap the later kind sees the
    earlier one's mask; no confirmed match of any kind is left.
    """
    by_name = {k.name: k for k in KINDS}
    for name in ("email", "iban", "card", "ssn", "routing", "ip", "phone"):
        docs = docs.withColumn(text_col, _without(F.col(text_col), by_name[name]))
    return docs
