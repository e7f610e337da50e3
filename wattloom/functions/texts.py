"""Text normalisation, tokens, character trigrams and HTML to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that German names use side by side, and accents that queries often omit.
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"}
ACCENTED = "àáâãåçèéêëìíîïñòóôõùúûýÿ"
PLAIN = "aaaaaceeeeiiiinoooouuuyy"

# Named HTML characters. The ampersand is decoded last.
ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&euro;", "€"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"),
    ("&szlig;", "ß"), ("&amp;", "&"),
]

# Words that mark a complaint or a praise in a ticket.
NEGATIVE_WORDS = ("defekt", "Störung", "Beschwerde", "nicht")
POSITIVE_WORDS = ("Lob",)


# A tag with quoted attributes; the count bounds how deep the pattern engine goes.
TAG = r"""<[a-zA-Z/!?](?:"[^"]*+"|'[^']*+'|[^'">]++){0,400}+>"""


def folded(value: Column) -> Column:
    """Lower case, umlauts spelled out, accents dropped, runs of other characters as one space."""
    value = F.lower(value)
    for letter, spelling in UMLAUTS.items():
        value = F.replace(value, F.lit(letter), F.lit(spelling))
    return F.trim(F.regexp_replace(F.translate(value, ACCENTED, PLAIN), "[^a-z0-9]+", " "))


def trigrams(value: Column) -> Column:
    """Distinct three-character windows of a folded string, padded so that word starts count."""
    padded = F.concat(F.lit("  "), value, F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(padded) - 2)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(3))))


def tokens(value: Column) -> Column:
    """Lower-case words of the whole text."""
    return F.filter(F.split(F.lower(value), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def numbers_decoded(text: Column) -> Column:
    """Numbered HTML characters, decimal or hexadecimal; what is no character stays as it is. The ampersand (38) is left to be decoded last."""
    def decoded(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        point = F.when(digits.rlike("^[xX]"), F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(digits).try_cast("int")
        valid = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point <= 0x10FFFF))
        character = F.when(point == 38, "&amp;").otherwise(F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(32)), 8, "0")), "UTF-32"))
        rest = F.substr(piece, F.length(digits) + 2)
        return F.when(valid, F.concat(character, rest)).otherwise(F.concat(F.lit("&#"), piece))

    def joined(pieces: Column) -> Column:
        later = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), decoded)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(later, ""))

    return F.get(F.transform(F.array(F.split(text, "&#")), joined), F.lit(0))  # a list of one, so that the text is cut once


def html_text(html: Column) -> Column:
    """Readable text of a page: no comments, scripts, styles or tags, entities decoded, blanks collapsed.

    A ``<`` starts a tag only before a letter, ``/``, ``!`` or ``?``; a ``>`` in a quoted attribute does not end it.
    """
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<script[^>]*>.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style[^>]*>.*?</style>", " ")
    text = F.regexp_replace(text, TAG, " ")
    text = F.regexp_replace(text, r"(?s)<[a-zA-Z/!?][^>]*>", " ")  # quotes that never close
    text = numbers_decoded(text)
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def ticket_tone(description: Column) -> Column:
    """Rule-based tone of a ticket; a complaint word wins over a praise word."""
    return (F.when(description.rlike("|".join(NEGATIVE_WORDS)), "negative")
            .when(description.rlike("|".join(POSITIVE_WORDS)), "positive")
            .otherwise("neutral"))


def file_title(path: Column) -> Column:
    return F.regexp_substr(path, F.lit("[^/]+$"))
