"""Column expressions shared by the operators; all stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import patterns as P


def any_match(c: Column, patterns: list[str]) -> Column:
    """True where one of the patterns is found."""
    return F.coalesce(F.lit(False) if not patterns else c.rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def any_word(c: Column, words: list[str]) -> Column:
    """True where one of the literal words occurs."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return F.coalesce(out, F.lit(False))


def ladder(rules: list[tuple[str, Column]], default: str | None = None) -> Column:
    """The label of the first rule that holds."""
    out = None
    for label, test in rules:
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def lines_of(text: Column) -> Column:
    """Lines without terminators; a final terminator opens no line (all Unicode line ends count)."""
    body = F.regexp_replace(text, r"\r\n|[\r\x{0B}\f\x{1C}\x{1D}\x{1E}\x{85}\x{2028}\x{2029}]", "\n")
    cut = F.split(body, "\n", -1)
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)
    )


def words_of(text: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(F.split(F.trim(text), r"\s+"), lambda x: x != "")


def search_tokens(text: Column) -> Column:
    """lower-case alphanumeric runs longer than one character, stop words left out."""
    stop = F.array(*[F.lit(w) for w in sorted(P.STOPWORDS)])
    found = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(found, lambda t: (F.length(t) > 1) & ~F.array_contains(stop, t))


def index_tokens(text: Column) -> Column:
    """tokens of the inverted index, two to twenty-five characters, short acronyms kept."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z][A-Za-z0-9\-]{1,24}"), F.lit(0)), F.lower)


def slugify(text: Column) -> Column:
    """Lower-case slug of at most 40 characters, a leading N.N dropped."""
    s = F.regexp_replace(F.lower(text), r"^\d+\.\d+\s*", "")
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)[^\w\s]", " "), r"(?U)\s+", "_")
    return F.substring(F.regexp_replace(s, "^_+|_+$", ""), 1, 40)


def first_words(text: Column, n: int) -> Column:
    """The first n words joined by single spaces."""
    return F.array_join(F.slice(words_of(text), 1, n), " ")


def normalise_anchor(text: Column) -> Column:
    """emphasis marks dropped and dashes folded; quotes stay as they are."""
    return F.trim(F.translate(F.regexp_replace(text, r"\*+|_+|`+", ""), "–—", "--"))


def sentences(line: Column, least: int) -> Column:
    """Sentences of a line of at least so many characters; the whole line where no sentence is long enough."""
    parts = F.filter(F.transform(F.split(line, r"(?<=[.!?])\s+"), F.trim), lambda s: F.length(s) >= least)
    whole = F.when(F.length(line) >= least, F.array(line)).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(parts) > 0, parts).otherwise(whole)


def prose_units(body: Column) -> Column:
    """sentences of 20 characters or more, tables and headings skipped."""
    kept = F.filter(F.transform(lines_of(body), F.trim), lambda s: (s != "") & ~s.startswith("|") & ~s.rlike(r"^#{1,6}\s"))
    return F.flatten(F.transform(kept, lambda s: sentences(s, 20)))


def anchor_units(body: Column) -> Column:
    """pieces of 8 characters or more by which a body is found in its source; table rows count whole."""
    kept = F.filter(F.transform(lines_of(body), F.trim), lambda s: (s != "") & ~s.rlike(r"^#{1,6}\s") & ~s.rlike(r"^\|?\s*-+\s*\|"))

    def units(s: Column) -> Column:
        cells = F.trim(F.regexp_replace(s, r"^\|+|\|+$", ""))
        row = F.when(F.length(cells) >= 8, F.array(F.substring(cells, 1, 100))).otherwise(F.array().cast("array<string>"))
        return F.when(s.startswith("|"), row).otherwise(sentences(F.regexp_replace(s, r"^[-*]\s+", ""), 8))

    return F.flatten(F.transform(kept, units))


def short_hash(*fields: Column) -> Column:
    """the first eight hex digits of the sha-256 of fields joined by |, nulls written None."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("None")) for f in fields]), 256), 1, 8)


def prefixed_hash(prefix: str, digits: int, *fields: Column) -> Column:
    """an upper-case id from the leading hex digits of each field's sha-256."""
    return F.concat_ws("-", F.lit(prefix), *[F.upper(F.substring(F.sha2(f, 256), 1, digits)) for f in fields])


def replace_all(c: Column, table: dict[str, str]) -> Column:
    """literal replacements in the table's order."""
    for a, b in table.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def rewrite(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Regex rewrites in order."""
    for pattern, to in rules:
        c = F.regexp_replace(c, pattern, to)
    return c


def luminance(r: Column, g: Column, b: Column) -> Column:
    """relative luminance of 8-bit sRGB."""

    def part(x: Column) -> Column:
        v = x / F.lit(255.0)
        return F.when(v <= 0.03928, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))

    return part(r) * 0.2126 + part(g) * 0.7152 + part(b) * 0.0722


def contrast(a: Column, b: Column) -> Column:
    """contrast ratio of two luminances."""
    return (F.greatest(a, b) + 0.05) / (F.least(a, b) + 0.05)


def hamming_hex(a: Column, b: Column) -> Column:
    """F32: differing bits of two 16-digit hex hashes; halves keep each conversion below 64 bits."""
    half = lambda c, at: F.conv(F.substring(F.lpad(c, 16, "0"), at, 8), 16, 10).cast("bigint")
    return F.bit_count(half(a, 1).bitwiseXOR(half(b, 1))) + F.bit_count(half(a, 9).bitwiseXOR(half(b, 9)))


def semver(c: Column) -> Column:
    """(major, minor, patch, prerelease, build), null where the text is no version."""
    whole = F.regexp_extract(F.trim(c), P.SEMVER, 1)
    core = F.split(F.regexp_extract(whole, r"^([0-9.]+)", 1), r"\.")
    number = lambda k: F.get(core, F.lit(k)).cast("int")
    blank = lambda x: F.when(x != "", x)
    parsed = F.struct(
        number(0).alias("major"), number(1).alias("minor"), number(2).alias("patch"),
        blank(F.regexp_extract(whole, r"^[0-9.]+-([0-9A-Za-z.-]+)", 1)).alias("prerelease"), blank(F.regexp_extract(whole, r"\+([0-9A-Za-z.-]+)$", 1)).alias("build"),
    )
    return F.when(whole != "", parsed)


def semver_key(c: Column) -> Column:
    """An array that sorts by precedence; a release follows its prereleases, numbers precede words, builds do not count."""
    v = semver(c)
    core = F.transform(F.array(v["major"], v["minor"], v["patch"]), lambda x: F.lpad(x.cast("string"), 10, "0"))
    token = lambda t: F.when(t.rlike(r"^\d+$"), F.concat(F.lit("0"), F.lpad(t, 20, "0"))).otherwise(F.concat(F.lit("1"), t))
    tail = F.when(v["prerelease"].isNull(), F.array(F.lit("1"))).otherwise(F.concat(F.array(F.lit("0")), F.transform(F.split(v["prerelease"], r"\."), token)))
    return F.when(v.isNotNull(), F.concat(core, tail))


def bump(c: Column, part: str) -> Column:
    """the next major, minor or patch version, or the version given in `part`."""
    v = semver(c)
    if part.lower() == "major":
        return F.when(v.isNotNull(), F.format_string("%d.0.0", v["major"] + 1))
    if part.lower() == "minor":
        return F.when(v.isNotNull(), F.format_string("%d.%d.0", v["major"], v["minor"] + 1))
    if part.lower() == "patch":
        return F.when(v.isNotNull(), F.format_string("%d.%d.%d", v["major"], v["minor"], v["patch"] + 1))
    return F.lit(part)
