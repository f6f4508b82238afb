"""Text rules as Column expressions: words, personal data, licences, direction, quality, chunks, error rates, documents."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.edits import gram_hits, word_edits

#: The characters that part words (Unicode white space), for the regexes of any engine.
SPACES = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = f"[^{SPACES}]+"
#: The same characters for Spark's regexes, which ask for the commonest range first.
_WORD = f"[!-~[^{SPACES}]]+"

#: What counts as personal data. A whole match counts; SWIFT codes are upper case, for without that any
#: word of eight letters would be one.
PII = {
    "email": r"(?i)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"(\+?1[-.\s]?)?(\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}|\+?[0-9]{1,4}[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,9})",
    "pan": r"(?i)\b[A-Z]{5}[0-9]{4}[A-Z]{1}\b",
    "aadhaar": r"\b[0-9]{4}[\s-]?[0-9]{4}[\s-]?[0-9]{4}\b",
    "iban": r"(?i)\b[A-Z]{2}[0-9]{2}[A-Z0-9]{4}[0-9]{7}([A-Z0-9]?){0,16}\b",
    "swift": r"\b[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}([A-Z0-9]{3})?\b",
    "dob": r"\b(0?[1-9]|1[0-2])[-/](0?[1-9]|[12][0-9]|3[01])[-/](19|20)\d{2}\b|\b(0?[1-9]|[12][0-9]|3[01])[-/](0?[1-9]|1[0-2])[-/](19|20)\d{2}\b|\b(19|20)\d{2}[-/](0?[1-9]|1[0-2])[-/](0?[1-9]|[12][0-9]|3[01])\b",
    "credit_card": r"\b(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}|3[0-9]{13}|6(?:011|5[0-9]{2})[0-9]{12})\b",
    "ssn": r"\b\d{3}-?\d{2}-?\d{4}\b",
}
#: Licence families in order of precedence, and keyword lists.
LICENSES = (
    ("MIT", ("mit license", "mit copyright", "permission is hereby granted")),
    ("Apache", ("apache license", "apache software foundation", "apache 2.0")),
    ("GPL", ("gpl", "gnu general public license", "gpl-3.0")),
    ("BSD", ("bsd license", "berkeley software distribution", "bsd-3-clause")),
    ("CC", ("creative commons", "cc-by", "cc0", "creative commons attribution")),
    ("Custom", ("custom license", "proprietary", "all rights reserved")),
    ("Public Domain", ("public domain", "no copyright", "unrestricted use")),
)
ATTRIBUTION = ("attribution", "credit", "acknowledge", "cite", "reference", "author", "creator", "copyright", "license notice", "license text")
NOT_COMMERCIAL = ("no commercial use", "non-commercial", "not for commercial", "prohibited commercial", "commercial use prohibited")
NOT_MODIFIED = ("no modification", "no derivative", "no changes", "no alteration", "modification prohibited")
REQUIREMENTS = (("ShareAlike", ("share alike", "copyleft")), ("SameLicense", ("same license",)), ("SourceCode", ("source code",)), ("LicenseNotice", ("license notice",)))
#: Words after whose sentence the attribution text stands.
CREDITS = ("attribution", "credit", "acknowledge", "cite", "reference")
CREDIT_TEXT = r"[^.]*?\.(.*?)(?:\n\n|\n[A-Z]|$)"
#: Right-to-left blocks.
RTL = (
    r"[\x{0590}-\x{05FF}\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{FB1D}-\x{FDFF}\x{FE70}-\x{FEFF}\x{10A00}-\x{10A5F}\x{10A60}-\x{10A7F}\x{10B00}-\x{10B3F}"
    r"\x{10B40}-\x{10B5F}\x{10B60}-\x{10B7F}\x{10C00}-\x{10C4F}\x{10C80}-\x{10CFF}\x{10D00}-\x{10D3F}\x{10E80}-\x{10EBF}\x{10F00}-\x{10F2F}\x{10F30}-\x{10F6F}\x{10F70}-\x{10FAF}"
    r"\x{10FB0}-\x{10FDF}\x{10FE0}-\x{10FFF}\x{1E800}-\x{1E8DF}\x{1E900}-\x{1E95F}\x{1EC70}-\x{1ECBF}\x{1ED00}-\x{1ED4F}\x{1EE00}-\x{1EEFF}]"
)
#: Description checks.
ENGLISH = ("the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by")
GENERIC = ("this is a", "here is a", "the following", "as shown", "see below", "figure shows", "table contains", "image displays")
PICTURED = ("Table", "Figure", "Chart", "Graph")
NUMBER = r"\b\d+(?:\.\d+)?\b"
RELEVANT = {"Table": ("data", "table", "row", "column", "value", "number"), "Figure": ("image", "figure", "chart", "graph", "diagram", "visual")}


def blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words between runs of white space; none for null and blank texts."""
    return F.regexp_extract_all(blank(text), F.lit(_WORD), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACES}]+|[{SPACES}]+$", "")


def title(name: Column) -> Column:
    """A type's name in words, each with a capital."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def stamp(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def iso_stamp(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def elapsed(start: Column, stop: Column) -> Column:
    """Seconds from start to stop."""
    return (F.unix_micros(stop) - F.unix_micros(start)) / 1e6


def has_any(text: Column, keys) -> Column:
    lowered = F.lower(blank(text))
    found = F.lit(False)
    for k in keys:
        found = found | F.contains(lowered, F.lit(k))
    return found


def pii_hits(text: Column, types=tuple(PII), swift_any_case: bool = False) -> Column:
    """array<struct<type, original>> of every hit of the wanted types. Types may overlap: a card is a phone number too.
    With swift_any_case any word of eight or eleven letters is a SWIFT code."""
    def found(kind: str) -> Column:
        hits = F.regexp_extract_all(blank(text), F.lit(("(?iU)" if swift_any_case and kind == "swift" else "(?U)") + PII[kind]), F.lit(0))
        may = {"email": F.contains(text, F.lit("@")), "swift": F.lit(True)}.get(kind, text.rlike(r"(?U)\d"))  # every other kind has a digit
        none = F.array().cast("array<struct<type:string,original:string>>")
        return F.when(may, F.transform(hits, lambda o: F.struct(F.lit(kind).alias("type"), o.alias("original")))).otherwise(none)

    return F.concat(*(found(k) for k in types))


def redact(original: Column, kind: Column) -> Column:
    """Keeps one character at either end of an address, two elsewhere; all stars where that leaves nothing hidden; a
    date loses its year; anything else is all stars."""
    n = F.length(original)
    stars = F.repeat(F.lit("*"), n)
    keep = lambda k: F.when(n > 2 * k, F.concat(F.substring(original, F.lit(1), F.lit(k)), F.repeat(F.lit("*"), n - 2 * k), F.substring(original, n - k + 1, F.lit(k)))).otherwise(stars)
    dated = F.when(original.rlike("[-/][0-9]{4}$"), F.regexp_replace(original, "[0-9]{4}$", "****")).when(original.rlike("^[0-9]{4}[-/]"), F.regexp_replace(original, "^[0-9]{4}", "****")).otherwise(stars)
    return F.when(kind == "dob", dated).when(kind == "email", keep(1)).when(kind.isin(*PII), keep(2)).otherwise(stars)


def context(text: Column, original: Column, width: int = 50) -> Column:
    """The first place of a hit with `width` characters on either side; dots where text is left out; empty if absent."""
    at = F.call_function("locate", original, text)
    start, stop = F.greatest(F.lit(1), at - width), F.least(F.length(text), at + F.length(original) - 1 + width)
    body = F.substring(text, start, stop - start + 1)
    return F.when(at == 0, "").otherwise(F.concat(F.when(start > 1, "...").otherwise(""), body, F.when(stop < F.length(text), "...").otherwise("")))


def license_type(text: Column) -> Column:
    out = F.lit("Unknown")
    for name, keys in reversed(LICENSES):
        out = F.when(has_any(text, keys), F.lit(name)).otherwise(out)
    return out


def attribution_text(text: Column, preview: int = 500) -> Column:
    """What follows the sentence of the first credit word that has one, in the first `preview` characters; else empty."""
    head, out = F.substring(blank(text), 1, preview), F.lit("")
    for word in reversed(CREDITS):
        pattern = f"(?is){word}{CREDIT_TEXT}"
        out = F.when(head.rlike(pattern), strip(F.regexp_extract(head, pattern, 1))).otherwise(out)
    return out


def license_terms(text: Column) -> dict[str, Column]:
    """license_type, requires_attribution, attribution_text, commercial_use, modification_allowed, requirements; the
    last four by the first 500 characters."""
    head = F.substring(blank(text), 1, 500)
    return {
        "license_type": license_type(text), "requires_attribution": has_any(text, ATTRIBUTION), "attribution_text": attribution_text(text),
        "commercial_use": ~has_any(head, NOT_COMMERCIAL), "modification_allowed": ~has_any(head, NOT_MODIFIED),
        "requirements": F.array_compact(F.array(*(F.when(has_any(head, keys), F.lit(name)) for name, keys in REQUIREMENTS))),
    }


def rtl_chars(text: Column) -> Column:
    return F.regexp_count(blank(text), F.lit(RTL))


def direction_of(rtl: Column, total: Column) -> tuple[Column, Column, Column, Column]:
    """Share of right-to-left characters (0 without any), whether it is right-to-left (over .6) and whether mixed (.3 to
    .7; both may hold), and the larger share."""
    ratio = F.coalesce(F.try_divide(rtl.cast("double"), total), F.lit(0.0))
    return ratio, ratio > 0.6, (ratio > 0.3) & (ratio < 0.7), F.when(total == 0, 0.0).otherwise(F.greatest(ratio, 1 - ratio))


def direction(text: Column) -> tuple[Column, Column, Column]:
    """Right-to-left share of all characters; rtl over .6, else mixed over .3, else ltr; and the larger share."""
    ratio, rtl, mixed, sure = direction_of(rtl_chars(text), F.length(blank(text)))
    return ratio, F.when(rtl, "rtl").when(mixed, "mixed").otherwise("ltr"), sure


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), value being evaluated once a row, whatever lambdas in body refer to it."""
    return F.transform(F.array(value), body)[0]


def chunks(text: Column, size: int = 220, overlap: int = 30) -> Column:
    """Overlapping windows of words; a text of up to `size` words is one chunk, unchanged. None for null."""
    def windows(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - 1, F.lit(0)), F.lit(size - overlap))
        return F.when(F.size(ws) <= size, F.array(text)).otherwise(F.transform(starts, lambda i: F.array_join(F.slice(ws, i + 1, size), " ")))

    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(let(words(text), windows))


def char_error_rate(truth: Column, guess: Column) -> Column:
    """Edits per true character; 0 for two empty texts, 1 if only the truth is empty."""
    return F.when(F.length(truth) == 0, F.when(F.length(guess) == 0, 0.0).otherwise(1.0)).otherwise(F.levenshtein(truth, guess) / F.length(truth))


def word_error_rate(truth: Column, guess: Column) -> Column:
    """Word edits per true word, of word lists; 0 for two empty lists, 1 if only the truth is empty."""
    return F.when(F.size(truth) == 0, F.when(F.size(guess) == 0, 0.0).otherwise(1.0)).otherwise(word_edits(truth, guess) / F.size(truth))


def bleu(truth: Column, guess: Column) -> Column:
    """BLEU of word lists over 1- to 4-grams, with .1 in place of no hits and the brevity penalty; 0 without a common word."""
    def score(hits: Column) -> Column:
        log_p = F.lit(0.0)
        for n in range(1, 5):
            log_p = log_p + 0.25 * F.ln(F.greatest(hits[n - 1].cast("double"), F.lit(0.1)) / F.greatest(F.lit(1), F.size(guess) - n + 1))
        return F.when(hits[0] == 0, 0.0).otherwise(F.exp(log_p + F.least(F.lit(0.0), 1 - F.size(truth) / F.size(guess))))

    return F.when((F.size(truth) == 0) | (F.size(guess) == 0), 0.0).otherwise(let(gram_hits(truth, guess), score))


#: What every document and every element must have.
DOCUMENT_FIELDS = ("document_id", "elements")
ELEMENT_FIELDS = ("class", "bbox", "content", "language", "page")


def document_error(payload: Column) -> Column:
    """The first thing wrong with a JSON document, null if it is valid. Fields are asked for in their order, elements in
    theirs; each element's error names its place from 0."""
    fields = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID"))

    def missing(m: Column, names, text) -> Column:
        out = F.lit(None).cast("string")
        for name in reversed(names):
            out = F.when(~F.map_contains_key(m, F.lit(name)), text(name)).otherwise(out)
        return out

    def wrong(e: Column, i: Column) -> Column:
        at = lambda what: F.concat(F.lit("Element "), i.cast("string"), F.lit(f" {what}"))

        def boxed(box: Column, value: Column) -> Column:
            whole = F.forall(box, lambda x: kind(x).isin("BIGINT", "BOOLEAN"))
            return (
                F.when(~kind(value).startswith("ARRAY") | (F.size(box) != 4), at("bbox must be a list of 4 integers")).when(~F.coalesce(whole, F.lit(False)), at("bbox must contain only integers"))
                .when(F.exists(box, lambda x: F.try_variant_get(x, "$", "long") < 0), at("bbox contains negative values"))
            )

        def judged(m: Column) -> Column:
            first = missing(m, ELEMENT_FIELDS, lambda f: at(f"missing required field: {f}"))
            box = let(m["bbox"], lambda v: let(F.try_variant_get(v, "$", "array<variant>"), lambda box: boxed(box, v)))
            return F.when(~kind(e).startswith("OBJECT") | m.isNull(), at("is not a dictionary")).otherwise(F.coalesce(first, box))

        return let(fields(e), judged)

    def judged(parsed: Column, top: Column) -> Column:
        first = missing(top, DOCUMENT_FIELDS, lambda f: F.lit(f"Missing required field: {f}"))
        errors = F.array_compact(F.transform(F.try_variant_get(top["elements"], "$", "array<variant>"), wrong))
        listed = F.when(~kind(top["elements"]).startswith("ARRAY"), "'elements' must be a list").otherwise(F.get(errors, F.lit(0)))
        return F.when(parsed.isNull() | ~kind(parsed).startswith("OBJECT") | top.isNull(), "Not a JSON object").otherwise(F.coalesce(first, listed))

    return let(F.try_parse_json(payload), lambda parsed: let(fields(parsed), lambda top: judged(parsed, top)))


def valid_document(payload: Column) -> Column:
    """Whether a JSON text has document_id and a list of elements, each with its five fields and a box of four whole
    numbers from 0; false for text that is no JSON object."""
    return document_error(payload).isNull()


def top_words(word_list: Column, n: int = 3) -> Column:
    """array<struct<word, n>> of the n commonest words, by number and then by their first place."""
    placed = F.array_sort(F.transform(word_list, lambda w, i: F.struct(w.alias("word"), i.alias("at"))))

    def counted(ws: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(ws), F.lit(1))), lambda i: (i == 1) | (F.get(ws, i - 1)["word"] != F.get(ws, i - 2)["word"]))
        return let(firsts, lambda at: F.transform(at, lambda a, k: F.struct((a - F.coalesce(F.get(at, k + 1), F.size(ws) + 1)).alias("n"), F.get(ws, a - 1)["at"].alias("at"), F.get(ws, a - 1)["word"].alias("word"))))

    best = F.when(F.size(word_list) > 0, F.slice(F.array_sort(let(placed, counted)), 1, n)).otherwise(F.array())
    return F.transform(best, lambda e: F.struct(e["word"].alias("word"), (-e["n"]).alias("n")))


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(blank(text), r"[.!?]+"), strip), lambda s: s != "")


def qa_flags(text: Column, kind: Column, page_language: Column | None = None, most_words: int = 80) -> Column:
    """array<struct<issue, severity>> in the order of the checks: length, language (where a page language is given),
    numbers, sentences, repetition, relevance. Null and empty texts have none. A text is lower-cased, cut into words and
    cut into sentences once; a sentence without a word is none."""
    flag = lambda cond, issue, severity: F.when(cond, F.struct(F.lit(issue).alias("issue"), F.lit(severity).alias("severity")))
    holds = lambda lowered, keys: functools.reduce(lambda a, k: a | F.contains(lowered, F.lit(k)), keys, F.lit(False))
    ascii_, numbers = ~blank(text).rlike(r"[^\x00-\x7F]"), F.regexp_count(blank(text), F.lit("(?U)" + NUMBER))

    def judged(t: Column) -> Column:
        n, lowered = t["n"], t["lowered"]
        missing = F.lit(False)
        for k, names in RELEVANT.items():
            missing = missing | ((kind == k) & ~holds(lowered, names))
        return F.array_compact(F.array(
            flag(n > most_words, "length_excessive", "medium"), flag(n < 3, "length_insufficient", "high"),
            *([flag((page_language == "en") & ~(t["ascii"] & holds(lowered, ENGLISH)), "language_mismatch", "medium")] if page_language is not None else []),
            flag(kind.isin(*PICTURED) & (t["numbers"] == 0), "missing_numerics", "medium"),
            flag(t["longest"] == 0, "no_sentences", "high"), flag(t["longest"] > 30, "long_sentences", "low"),
            flag((n >= 5) & (t["distinct"] * 2 < n), "excessive_repetition", "medium"),
            flag(t["generic"] > 2, "generic_content", "low"), flag((t["generic"] <= 2) & missing, "inappropriate_content", "medium"),
        ))

    def counted(t: Column) -> Column:
        generic = sum((F.contains(t["lowered"], F.lit(p)).cast("int") for p in GENERIC), F.lit(0))
        return F.struct(t["lowered"].alias("lowered"), F.size(t["ws"]).alias("n"), F.size(F.array_distinct(t["ws"])).alias("distinct"), generic.alias("generic"), t["ascii"].alias("ascii"), t["numbers"].alias("numbers"), t["longest"].alias("longest"))

    longest = F.array_max(F.transform(F.split(blank(text), r"[.!?]+"), lambda s: F.regexp_count(s, F.lit(_WORD))))
    cut = lambda lowered: F.struct(lowered.alias("lowered"), words(lowered).alias("ws"), ascii_.alias("ascii"), numbers.alias("numbers"), longest.alias("longest"))
    flags = let(let(let(F.lower(blank(text)), cut), counted), judged)
    return F.when(blank(text) == "", F.array().cast("array<struct<issue:string,severity:string>>")).otherwise(flags)
