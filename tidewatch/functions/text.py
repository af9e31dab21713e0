"""Text expressions: trimming, CSV fields, RFC 3339 times and the text view of an event."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.rules import DOTLESS_I, DOTTED_I, OTHER_LETTER

# Every character with the Unicode White_Space property; Spark's trim only drops blanks.
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def present(col: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def rfc3339(ts: Column) -> Column:
    """UTC time as RFC 3339 text with no, three or six fraction digits, as many as needed."""
    ts = ts.cast("timestamp")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(
        F.when(micros == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(micros % 1000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.lit("+00:00"),
    )


# A field is quoted only when its first character is a quote; text after the closing quote
# is kept as it stands, and a quote inside an unquoted field is an ordinary character.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+(?:"[^,\r\n]*+)?'
_FIELD = rf'(?:{_QUOTED}|[^,\r\n]*+)'


def csv_fields(line: Column) -> Column:
    """Fields of the first CSV record of ``line``."""
    record = F.when(
        line.rlike(r"[\r\n]"),
        F.regexp_extract(line, rf"^[\r\n]*+({_FIELD}(?:,{_FIELD})*+)", 1),
    ).otherwise(line)
    pieces = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_FIELD})"), 1)
    # Most lines hold no quote at all: a plain split is several times cheaper.
    return F.when(record.contains('"'), F.transform(pieces, _unquote)).otherwise(
        F.split(record, ",", -1)
    )


def _unquote(piece: Column) -> Column:
    parts = r'^"([^"]*+(?:""[^"]*+)*+)(?:"([^,\r\n]*+))?'
    return F.when(
        piece.startswith('"'),
        F.concat(
            F.replace(F.regexp_extract(piece, parts, 1), F.lit('""'), F.lit('"')),
            F.regexp_extract(piece, parts, 2),
        ),
    ).otherwise(piece)


@dataclass(frozen=True)
class TextView:
    """The string values of an event, in key order, in the forms the detectors read.

    ``lines``  joined by line feeds: no indicator or pattern can match across two values
    ``joined`` joined by blanks: what keyword lists and correlation rules look at
    ``leaves`` array<struct<ord, path, value>>
    """

    lines: Column
    joined: Column
    leaves: Column


def sql_text(value: str) -> str:
    """A SQL string literal. Wide, generated expressions are built as SQL text: one call each."""
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if " " <= c < "\x7f" else f"\\u{ord(c):04X}" for c in quoted) + "'"


def replaced(text: str, *pairs: tuple[str, str], within: str | None = None) -> str:
    """SQL: ``text`` with the first of each pair replaced by the second; only a text that has it, or ``within`` has it, is gone through.

    Spark compares a searched text at every byte when it replaces, but looks for a first byte when it asks whether it is there.
    """
    found, result = within or text, text
    for old, new in pairs:
        result = f"replace({result}, {sql_text(old)}, {sql_text(new)})"
    return f"if({' or '.join(f'contains({found}, {sql_text(old)})' for old, _ in pairs)}, {result}, {text})"


def plain_case(text: str) -> str:
    """SQL: ``text`` without the two letters whose case Java folds differently."""
    return replaced(text, (DOTTED_I, OTHER_LETTER), (DOTLESS_I, OTHER_LETTER))


def flat_view(values: dict[str, str]) -> TextView:
    """View over top-level fields, path -> SQL expression; keys are visited in byte order."""
    ordered = sorted(values.items())
    columns = ", ".join(value for _, value in ordered)
    leaves = ", ".join(
        f"named_struct('ord', {i}, 'path', {sql_text(path)}, 'value', {value})"
        for i, (path, value) in enumerate(ordered)
    )
    return TextView(
        lines=F.expr(f"concat_ws('\\n', {columns})"),
        joined=F.expr(f"concat_ws(' ', {columns})"),
        leaves=F.expr(f"filter(array({leaves}), leaf -> leaf.value is not null)"),
    )


def array_view(values: Column, leaves: Column) -> TextView:
    """View over an array of all values and an array<struct<ord, path, value>> of them.

    The second is worked out only where a pattern was found in the first.
    """
    return TextView(F.array_join(values, "\n"), F.array_join(values, " "), leaves)
