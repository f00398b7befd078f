"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its shape and kept only if it validates (a card number's check digit, an IBAN's
remainder, the octets of an address, a calendar's day ...). It is then permuted, with a key, among
the valid values of its own format, by an alternating Feistel network over the value's positions:
one half, hashed with the key, the format and the round, is added to the other half position by
position, each modulo its own size. As that is a permutation, equal values get equal pseudonyms in all
documents and different values different ones, and no table of values is kept.

Only DataFrame functions are used, and rows are never shuffled: one pass of the shapes puts marks
around a text's findings, each in the place of its kind, the text is split at the marks, and the pieces are joined
with the pseudonyms. All shapes are bounded, so that the work is in proportion to a text's length, whatever it holds.

Kinds, in the order in which they are tried at a position:

=====  =======================================================  =====================================
kind   valid                                                    permuted
=====  =======================================================  =====================================
email  up to 64 characters, @, a domain of up to 33 labels      letters and digits before the last dot
iban   letters, digits, remainder 1 modulo 97                   the account's part; check digits anew
date   y-m-d, y/m/d, d.m.y, d/m/y or m/d/y; 1900 to 2099;       the day, among all days of that format
       days and months of two digits; a time may follow T
phone  +country and 8 to 14 digits, or (3) 3-4, or 3-3-4        digits after the country code
ssn    3-2-4, with the area, group and serial in use            all digits; again until they are in use
ip     four octets of 0 to 255 without leading zeros            the octets
card   13 to 19 digits, spaces or hyphens between, check digit  digits but the last; that one anew
=====  =======================================================  =====================================

Defined results: a null text stays null and has no findings; all other texts keep every character
outside findings; rows are kept as they are, repeated ones too; other columns are carried along, and where one has the name
of the findings' column, the new one gets a number behind its name; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm.common import free_name

#: Rounds of the network; an even number, so that the halves end in their places.
ROUNDS = 8
KINDS = ("email", "iban", "date", "phone", "ssn", "ip", "card")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Shapes, as regular expressions; what stands before and after a finding is checked too.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,32}[A-Za-z]{2,63}+(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:(?:19|20)\d\d-\d\d-\d\d|(?:19|20)\d\d/\d\d/\d\d|\d\d\.\d\d\.(?:19|20)\d\d|\d\d/\d\d/(?:19|20)\d\d)(?![0-9A-SU-Za-z]|T(?!\d\d:))(?![./-]\d)",
    "phone": r"(?<![0-9A-Za-z+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|(?<![0-9][.-])\d{3}-\d{3}-\d{4})(?![0-9A-Za-z])(?!-\d)",
    "ssn": r"(?<![0-9A-Za-z])(?<![0-9]-)\d{3}-\d\d-\d{4}(?![0-9A-Za-z])(?!-\d)",
    "ip": rf"(?<![0-9A-Za-z])(?<!\d\.){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z])(?!\.\d)",
    "card": r"(?<![0-9A-Za-z])(?<!\d[-.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?![0-9A-Za-z])(?![.-]\d)",
}
ANY = "|".join(f"({SHAPES[k]})" for k in KINDS)
#: What separates the pieces of a marked text, and what stands for its first character in a text that holds it.
MARK, ESCAPED = "\ue000\ue001", "\ue000\ue002"
#: Findings whose places are added up together; places of such blocks are then added up.
BLOCK = 256
#: First day and number of days of the dates that are permuted; 319 * 229 is that number.
FIRST_DAY, DAYS = "1900-01-01", (319, 229)


def feistel(values: Column, sizes: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """Permute an array of longs, the i-th below ``sizes[i]``, of two positions or more; keyed and tweaked."""
    half = F.floor(F.size(values) / 2).cast("int")
    n = F.size(values)
    start = F.struct(
        F.slice(values, 1, half).alias("a"), F.slice(sizes, 1, half).alias("ma"),
        F.slice(values, half + 1, n - half).alias("b"), F.slice(sizes, half + 1, n - half).alias("mb"),
        tweak.alias("t"),
    )

    def turn(s: Column, i: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), s["t"], i.cast("string"), F.array_join(F.transform(s["b"], lambda x: x.cast("string")), ","))
        # 60 bits of a hash for each position
        added = F.transform(
            s["a"],
            lambda x, j: F.pmod(x + F.conv(F.substring(F.sha2(F.concat_ws("|", seed, j.cast("string")), 256), 1, 15), 16, 10).cast("long"), F.get(s["ma"], j)),
        )
        return F.struct(s["b"].alias("a"), s["mb"].alias("ma"), added.alias("b"), s["ma"].alias("mb"), s["t"].alias("t"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _permute_characters(text: Column, tweak: Column, key: str, letters: bool) -> Column:
    """Letters within their case and digits among themselves, all other characters unchanged."""
    low, up = F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    def own(c: Column) -> Column:  # the alphabet of a character
        if not letters:
            return F.when(c.between("0", "9"), F.lit("0123456789"))
        return F.when(c.between("0", "9"), F.lit("0123456789")).when(c.between("a", "z"), low).when(c.between("A", "Z"), up)

    moved = F.filter(_characters(text), lambda c: own(c).isNotNull())
    values = F.transform(moved, lambda c: (F.instr(F.lit("0123456789"), c) if not letters else F.when(c.between("0", "9"), F.instr(F.lit("0123456789"), c)).when(c.between("a", "z"), F.instr(low, c)).otherwise(F.instr(up, c))).cast("long") - 1)
    sizes = F.transform(moved, lambda c: F.length(own(c)).cast("long"))
    # evaluated once, then read position by position
    state = F.aggregate(
        _characters(text),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at"), feistel(values, sizes, tweak, key).alias("new")),
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(own(c).isNotNull(), F.substring(own(c), F.get(s["new"], s["at"]).cast("int") + 1, F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.when(own(c).isNotNull(), 1).otherwise(0)).alias("at"),
            s["new"].alias("new"),
        ),
        lambda s: s["out"],
    )
    return F.when(F.size(moved) < 2, text).otherwise(state)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _check_sum(digits: Column, last: bool) -> Column:
    """Luhn's sum; ``last``: whether the check digit is among the digits."""
    doubled = 1 if last else 0
    return F.aggregate(
        _characters(F.reverse(digits)),
        F.struct(F.lit(0).alias("s"), F.lit(0).alias("i")),
        lambda s, c: F.struct(
            (s["s"] + F.when(s["i"] % 2 == doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))).alias("s"),
            (s["i"] + 1).alias("i"),
        ),
        lambda s: s["s"],
    )


def _remainder_97(text: Column) -> Column:
    """Of an IBAN's characters (bank and account first, then country and check digits), letters as 10 to 35."""
    return F.aggregate(
        _characters(text),
        F.lit(0),
        lambda r, c: F.when(c.between("0", "9"), (r * 10 + F.instr(F.lit("0123456789"), c) - 1) % 97).otherwise((r * 100 + F.instr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) + 9) % 97).cast("int"),
    )


def _date(text: Column) -> Column:
    """(day, pattern) of a date; null if there is no such day. A slashed date is day first if it can be."""
    options = [
        (r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"^\d\d\.", "dd.MM.yyyy"), (r"^\d\d/", "dd/MM/yyyy"),
    ]
    found = F.lit(None).cast("struct<day:date,pattern:string>")
    for shape, pattern in options:
        y, m, d = (F.substring(text, pattern.index(p[0]) + 1, len(p)) for p in ("yyyy", "MM", "dd"))
        day = F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")
        found = F.when(text.rlike(shape) & day.isNotNull(), F.struct(day.alias("day"), F.lit(pattern).alias("pattern"))).otherwise(found)
    return found


def _day_of_american(text: Column) -> Column:
    """The day of mm/dd/yyyy with a day from 13 on, else null."""
    day = F.try_to_date(F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 2), F.substring(text, 4, 2)), "yyyy-MM-dd")
    return F.when(text.rlike(r"^\d\d/(?:1[3-9]|2\d|3[01])/"), day)


def is_valid(text: Column, kind: Column) -> Column:
    """Whether a finding with a kind's shape validates."""
    flat = F.regexp_replace(text, " ", "")
    moved = F.concat(F.substring(flat, 5, 40), F.substring(flat, 1, 4))
    n = F.length(_digits(text))
    return (
        F.when(kind == "iban", (_remainder_97(moved) == 1) & F.length(flat).between(15, 34))
        .when(kind == "date", _date(text).isNotNull() | _day_of_american(text).isNotNull())
        .when(kind == "phone", n.between(9, 15))
        .when(kind == "ssn", ~text.rlike("^(?:000|666|9)") & ~text.rlike("-00-") & ~text.rlike("-0000$"))
        .when(kind == "card", n.between(13, 19) & (_check_sum(_digits(text), True) % 10 == 0) & ~_digits(text).rlike("^0+$"))
        .otherwise(F.lit(True))
    )


def pseudonym(text: Column, kind: Column, key: str) -> Column:
    """The keyed pseudonym of a valid finding, in its own format."""
    shape = F.concat_ws("|", kind, F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[a-z]", "a"))

    dot = F.length(F.substring_index(text, ".", -1)) + 1
    head, tail = F.substring(text, F.lit(1), F.length(text) - dot), F.substring(text, F.length(text) - dot + 1, dot)
    email = F.concat(_permute_characters(head, shape, key, True), tail)

    code = F.regexp_extract(text, r"^(\+\d{1,3})[ .(-]", 1)
    code = F.when(code == "", F.regexp_extract(text, r"^(\+\d)", 1)).otherwise(code)
    phone = F.concat(code, _permute_characters(F.substring(text, F.length(code) + 1, F.length(text)), F.concat_ws("|", shape, code), key, False))

    octets = F.transform(F.split(text, r"\."), lambda x: x.cast("long"))
    ip = F.array_join(F.transform(feistel(octets, F.array(*[F.lit(256).cast("long")] * 4), F.lit("ip"), key), lambda x: x.cast("string")), ".")

    body = F.substring(text, F.lit(1), F.length(text) - 1)
    new = _permute_characters(body, shape, key, False)
    card = F.aggregate(F.array(new), F.lit(""), lambda _, b: F.concat(b, F.pmod(-_check_sum(_digits(b), False), F.lit(10)).cast("string")))

    account = F.substring(text, 5, 60)
    iban = F.aggregate(
        F.array(_permute_characters(account, F.concat_ws("|", shape, F.substring(text, 1, 2)), key, True)),
        F.lit(""),
        lambda _, b: F.concat(F.substring(text, 1, 2), F.lpad((98 - _remainder_97(F.concat(F.regexp_replace(b, " ", ""), F.substring(text, 1, 2), F.lit("00")))).cast("string"), 2, "0"), b),
    )

    found = _date(text)
    index = F.datediff(found["day"], F.lit(FIRST_DAY).cast("date")).cast("long")
    places = feistel(F.array(F.floor(index / DAYS[1]), index % DAYS[1]), F.array(*[F.lit(x).cast("long") for x in DAYS]), F.concat_ws("|", F.lit("date"), found["pattern"]), key)
    new_day = F.aggregate(F.array(places), F.lit(FIRST_DAY).cast("date"), lambda _, p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p[0] * DAYS[1] + p[1]).cast("int")))
    date = F.lit(None).cast("string")
    for pattern in ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "dd/MM/yyyy"):
        date = F.when(found["pattern"] == pattern, F.date_format(new_day, pattern)).otherwise(date)
    # month first: days 13 to 28 with year and month; 29 to 31 keep day and month; a leap day its leap years
    year, month, day = (F.substring(text, a, b).cast("long") for a, b in ((7, 4), (1, 2), (4, 2)))
    many = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    early = feistel(F.array(year - 1900, month - 1, day - 13), many((200, 12, 16)), F.lit("mdy"), key)
    late = feistel(F.array(F.floor((year - 1900) / 10), (year - 1900) % 10), many((20, 10)), F.concat(F.lit("mdy"), F.substring(text, 1, 5)), key)
    leap = feistel(F.array(F.floor((year - 1904) / 28), F.floor((year - 1904) / 4) % 7), many((7, 7)), F.lit("leap"), key)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    american = F.when(day <= 28, F.aggregate(F.array(early), F.lit(""), lambda _, p: F.concat_ws("/", two(p[1] + 1), two(p[2] + 13), (p[0] + 1900).cast("string"))))
    american = american.when((month == 2) & (day == 29), F.concat(F.lit("02/29/"), F.aggregate(F.array(leap), F.lit(""), lambda _, p: (p[0] * 28 + p[1] * 4 + 1904).cast("string"))))
    american = american.otherwise(F.concat(F.substring(text, 1, 6), F.aggregate(F.array(late), F.lit(""), lambda _, p: (p[0] * 10 + p[1] + 1900).cast("string"))))
    date = F.coalesce(date, american)

    # cycle walking: permute until the number is one in use; 64 steps miss one in 10**60
    step = lambda s: _permute_characters(s, F.lit("ssn"), key, False)
    bad = lambda s: s.rlike("^(?:000|666|9)") | s.rlike("-00-") | s.rlike("-0000$")
    ssn = F.aggregate(F.sequence(F.lit(1), F.lit(64)), step(text), lambda s, _: F.when(bad(s), step(s)).otherwise(s))

    out = F.when(kind == "email", email).when(kind == "iban", iban).when(kind == "date", date).when(kind == "phone", phone)
    return out.when(kind == "ssn", ssn).when(kind == "ip", ip).when(kind == "card", card).otherwise(text)


def _running(sizes: Column) -> Column:
    """Sums of an array of ints up to each of its places, block by block, so that no array grows by one place at a time for long."""
    none = F.array().cast("array<int>")
    step = lambda sums, x: F.concat(sums, F.array(F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0)) + x))
    scan = lambda xs: F.aggregate(xs, none, step)
    blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(sizes), F.lit(1)), F.lit(BLOCK)), lambda at: scan(F.slice(sizes, at, BLOCK)))
    bases = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("sum"), none.alias("out")),
        lambda s, b: F.struct((s["sum"] + F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0))).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out")),
        lambda s: s["out"],
    )
    return F.flatten(F.zip_with(blocks, bases, lambda b, base: F.transform(b, lambda x: x + base)))


FINDINGS = "array<struct<kind:string,start:int,end:int>>"


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", out_col: str | None = None, findings_col: str = "findings") -> DataFrame:
    """``docs`` with the text's pseudonymised form (in its place, or in ``out_col``) and the findings (kind, start, end; code points of the original).

    Whoever knows ``key`` can turn pseudonyms back, so it has no default.
    """
    out_col = out_col or text_col
    text = F.col(f"`{text_col}`").cast("string")
    first = MARK[0]
    escaped = F.replace(text, F.lit(first), F.lit(ESCAPED))
    plain = lambda x: F.replace(x, F.lit(ESCAPED), F.lit(first))
    width = len(KINDS) + 1
    marked = F.regexp_replace(escaped, ANY, "".join(f"{MARK}${i}" for i in range(1, width)) + MARK)
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("old"), F.split(marked, MARK, -1).alias("pieces"))
    # pieces: text, a place per kind of which one is taken, text ...
    n = F.floor(F.size("pieces") / width).cast("int")

    def hit(i: Column) -> Column:
        own = F.slice("pieces", i * width + 2, len(KINDS))
        return F.struct(plain(F.get("pieces", i * width)).alias("before"), F.array_join(own, "").alias("was"), F.element_at(F.array(*map(F.lit, KINDS)), F.array_position(F.transform(own, lambda x: x != ""), True).cast("int")).alias("kind"))

    found = found.withColumn("hits", F.when(F.size("pieces") > 1, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), hit)))
    found = found.withColumn("hits", F.transform("hits", lambda h: F.struct(h["before"].alias("before"), h["was"].alias("was"), F.when(is_valid(h["was"], h["kind"]), h["kind"]).alias("kind"))))
    joined = F.concat(F.array_join(F.transform("hits", lambda h: F.concat(h["before"], F.when(h["kind"].isNull(), h["was"]).otherwise(pseudonym(h["was"], h["kind"], key)))), ""), plain(F.element_at("pieces", -1)))
    ends = _running(F.transform("hits", lambda h: F.length(h["before"]) + F.length(h["was"])))
    spans = F.zip_with("hits", ends, lambda h, end: F.when(h["kind"].isNotNull(), F.struct(h["kind"].alias("kind"), (end - F.length(h["was"])).alias("start"), end.alias("end"))))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != out_col]
    some = F.col("hits").isNotNull()
    findings = F.coalesce(F.when(some, F.array_compact(spans).cast(FINDINGS)), F.array().cast(FINDINGS))
    return found.select(*columns, F.when(some, joined).otherwise(F.col("old")).alias(out_col), findings.alias(free_name(findings_col, [*docs.columns, out_col])))
