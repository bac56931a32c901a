"""Typed columns out of untyped JSON cells.

A remote table arrives as one JSON array per row whose cells carry whatever JSON type the server
chose. The functions here write Spark SQL expressions over a cell; a cell that does not fit the
declared type becomes NULL and never an error. Spark's own casts are more lenient than the rules we
need (they trim blanks, truncate decimals, accept bare years and offsets), so every cast stands
behind a gate on the text.

A cell is mostly told by its text alone: a JSON string and a JSON number of the same text mean the
same. Where the JSON type matters as well (is this a number 5 or a text "5"?), the line is parsed
once more with a mark in front of every string, and a cell without the mark is no string. Only lines
that hold such a cell are parsed twice, and every cell is decided on its own.

The usual forms are handled by small expressions that stay inside generated code. Unusual ones are
handled in a lambda (:func:`_let`) that is only entered by the cells that need it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesnap.functions.types import RemoteColumn, snapshot_schema

# What a text cell may look like. Java's `$` also matches before a final newline,
# so the patterns end in \z.
INT_TEXT = r"^[+-]?[0-9]+\z"
FLOAT_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
FLOAT_WORD = r"^[+-]?(?i:nan|inf|infinity)\z"
TRUE_TEXT = r"^\p{IsWhite_Space}*(?i:true|t|1|yes|y)\p{IsWhite_Space}*\z"
FALSE_TEXT = r"^\p{IsWhite_Space}*(?i:false|f|0|no|n)\p{IsWhite_Space}*\z"

# Texts that do not tell enough, by declared type: numbers that are no truth value as a text;
# numbers with a fraction, an exponent or very many digits, arrays and objects, which are shown in a
# compact form unless they came as a text.
UNTOLD_BOOLEAN = r"^(?![01]\z)-?[0-9]+\z"
UNTOLD_TEXT = r"^(-?[0-9]+[.eE]|-?[0-9]{19}|-0\z|[\[{])"
# A line with a number negative zero, unless in a string: it is no integer, and reading it as one would lose its sign.
NEGATIVE_ZERO = r"-0\s*[],}]"

# The date and time layouts. USUAL_TEXT is read by a cast as it stands. The loose
# layouts (blanks before a number, short or signed years, a leap second, month first) are taken
# apart into sign, year, month, day, hour, minute, second, fraction.
USUAL_TEXT = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"([T ][0-9]{1,2}:[0-9]{1,2}:[0-5]?[0-9]([.][0-9]+)?Z?)?\z"
)
_SP = r"\p{IsWhite_Space}*"
_YEAR = rf"{_SP}([+-]?)([0-9]{{1,4}}|(?<=[+-])[0-9]+)"
_PART = rf"{_SP}([0-9]{{1,2}})"
_CLOCK = rf"(?:(?:T{_SP}|\p{{IsWhite_Space}}+)([0-9]{{1,2}}):{_PART}:{_PART}([.][0-9]+)?)?"
YEAR_FIRST = (rf"^{_YEAR}-{_PART}-{_PART}{_CLOCK}Z?\z", "$1|$2|$3|$4|$5|$6|$7|$8")
MONTH_FIRST = (rf"^{_PART}/{_PART}/{_YEAR}Z?\z", "$3|$4|$1|$2||||")

# The least and largest whole numbers of 64 bits.
MIN_SIGNED = "-9223372036854775808"
MAX_UNSIGNED = "18446744073709551615"

# Marks a number among the strings of a JSON text while its keys are sorted.
NUMBER_MARK = r"\u0001\u0002\u0003"

# Of equal keys of an object the last counts, as in most JSON readers; by default Spark takes none.
LAST_KEY_COUNTS = "spark.sql.variant.allowDuplicateKeys"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def to_int(text: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{INT_TEXT}' THEN try_cast({text} AS BIGINT) END"


def to_float(text: str) -> str:
    word = "try_cast(regexp_replace(lower(w), '^[+-]nan', 'nan') AS DOUBLE)"
    odd = _let("w", text, f"CASE WHEN w RLIKE r'{FLOAT_WORD}' THEN {word} END")
    return (
        f"CASE WHEN {text} RLIKE r'{FLOAT_TEXT}' THEN try_cast({text} AS DOUBLE) WHEN {text} IS NOT NULL THEN {odd} END"
    )


def to_boolean(text: str, is_string: str) -> str:
    whole = f"NOT {is_string} AND try_cast({text} AS BIGINT) IS NOT NULL"
    return (
        f"CASE WHEN {text} RLIKE r'{TRUE_TEXT}' THEN true WHEN {text} RLIKE r'{FALSE_TEXT}' THEN false "
        f"WHEN {text} RLIKE r'{UNTOLD_BOOLEAN}' AND {whole} THEN true END"
    )


def _loose_instant(text: str, rule: str) -> str:
    """``rule`` over ``instant`` and ``leap`` of a loosely written date or instant. Second 60 is the
    leap second after second 59: it gives the instant of second 59 and a true ``leap``."""

    def parts(layout: tuple[str, str]) -> str:
        pattern, order = layout
        return f"WHEN w RLIKE r'{pattern}' THEN split(regexp_replace(w, r'{pattern}', '{order}'), '[|]')"

    date = "concat(p[0], concat_ws('-', lpad(p[1], greatest(length(p[1]), 4), '0'), p[2], p[3]))"
    clock = "concat(' ', concat_ws(':', p[4], p[5], if(p[6] = '60', '59', p[6])), p[7])"
    instant = f"try_cast(concat({date}, if(p[4] = '', '', {clock})) AS TIMESTAMP_NTZ)"
    return _let(
        "w",
        text,
        _let(
            "p",
            f"CASE {parts(YEAR_FIRST)} {parts(MONTH_FIRST)} END",
            _let("x", f"named_struct('instant', {instant}, 'leap', p[6] = '60')", rule),
        ),
    )


def to_datetime(text: str) -> str:
    loose = _loose_instant(text, "if(x.leap, x.instant + INTERVAL 1 SECOND, x.instant)")
    return (
        f"CASE WHEN {text} RLIKE r'{USUAL_TEXT}' THEN try_cast({text} AS TIMESTAMP_NTZ) "
        f"WHEN {text} IS NOT NULL THEN {loose} END"
    )


def to_date(text: str) -> str:
    loose = _loose_instant(text, "CAST(x.instant AS DATE)")
    return (
        f"CASE WHEN {text} RLIKE r'{USUAL_TEXT}' THEN CAST(try_cast({text} AS TIMESTAMP_NTZ) AS DATE) "
        f"WHEN {text} IS NOT NULL THEN {loose} END"
    )


def number_text(value: str) -> str:
    """A double as the shortest decimal text that reads back as it, with an exponent only far from
    the decimal point."""
    # Java prints some doubles with more digits than they need. d.dddde+xx is taken apart into its
    # sign, its digits, and the number of the digit that the decimal point belongs after.
    shown = "CASE " + " ".join(
        f"WHEN CAST(format_string('%.{n}e', d) AS DOUBLE) = d THEN format_string('%.{n}e', d)" for n in (14, 15)
    ) + " ELSE format_string('%.16e', d) END"
    parts = (
        "named_struct('sign', if(s LIKE '-%', '-', ''), "
        r"'digits', regexp_replace(regexp_replace(s, r'^-|[.]|e.*\z', ''), r'(?<=.)0+\z', ''), "
        "'point', CAST(substring_index(s, 'e', -1) AS INT) + 1)"
    )
    plain = (
        "concat(n.sign, CASE "
        "WHEN n.point BETWEEN 1 AND 16 AND length(n.digits) <= n.point "
        "THEN concat(rpad(n.digits, n.point, '0'), '.0') "
        "WHEN n.point BETWEEN 1 AND 16 "
        "THEN concat(substring(n.digits, 1, n.point), '.', substring(n.digits, n.point + 1)) "
        "WHEN n.point BETWEEN -4 AND 0 THEN concat('0.', repeat('0', -n.point), n.digits) "
        "ELSE concat(substring(n.digits, 1, 1), if(length(n.digits) > 1, concat('.', substring(n.digits, 2)), ''), "
        "'e', n.point - 1) END)"
    )
    return _let("d", value, _let("s", shown, _let("n", parts, plain)))


def _outside_strings(json: str, inside: str, outside: str) -> str:
    """JSON text whose strings ``s`` become ``inside`` and whose stretches ``s`` between them ``outside``. Escapes
    of backslash and quote are masked first, by characters that JSON text never holds, so that quotes alternate."""
    backslash, quote = r"r'\\'", r"""r'\"'"""
    masked = f"replace(replace({json}, {backslash}, char(2)), {quote}, char(3))"
    parts = f"transform(split({masked}, '\"'), (s, i) -> if(i % 2 = 1, {inside}, {outside}))"
    return f"replace(replace(array_join({parts}, '\"'), char(3), {quote}), char(2), {backslash})"


def strings_marked(json: str) -> str:
    """JSON text with a mark at the begin of every string."""
    return _outside_strings(json, "concat(r'\\u0001', s)", "s")


def is_marked(cell: str) -> str:
    return f"coalesce(startswith({cell}, char(1)), true)"


def _is_float(token: str) -> str:
    """Whether a number is kept as a double: with a fraction or an exponent, negative zero, or an integer that fits
    neither 64 signed nor 64 unsigned bits."""
    fits = f"coalesce(try_cast({token} AS DECIMAL(38,0)) BETWEEN {MIN_SIGNED}BD AND {MAX_UNSIGNED}BD, false)"
    return f"({token} RLIKE '[.eE]' OR {token} = '-0' OR (length({token}) >= 19 AND NOT {fits}))"


def nested_text(json: str) -> str:
    """The compact text of a JSON array or object, with sorted keys, of which the last of equal ones counts.
    Doubles are written by :func:`number_text` at any depth: they are carried through the sorting as marked strings."""
    # A cell too large for a variant keeps its own text.
    shown = f"concat('\"', r'{NUMBER_MARK}', {number_text('CAST(t AS DOUBLE)')}, '\"')"
    number = f"t RLIKE '^-?[0-9]' AND {_is_float('t')}"
    tokens = "regexp_extract_all(s, r'-?[0-9][0-9.eE+-]*|[^0-9-]+', 0)"
    stretch = f"array_join(transform({tokens}, t -> if({number}, {shown}, t)), '')"
    marked = _outside_strings("j", "s", stretch)
    strip = NUMBER_MARK.replace("\\", "\\\\")
    sorted_text = f"regexp_replace(to_json(try_parse_json({marked})), r'\"{strip}(-?[0-9][0-9.e-]*)\"', '$1')"
    return _let("j", json, f"coalesce({sorted_text}, j)")


def json_text(json: str) -> str:
    """The text of a JSON value that is no string."""
    return (
        rf"CASE WHEN {json} RLIKE r'^[\[{{]' THEN {nested_text(json)} "
        f"WHEN {json} RLIKE '^-?[0-9]' AND {_is_float(json)} THEN {number_text(f'CAST({json} AS DOUBLE)')} ELSE {json} END"
    )


# The declared types that are told by the text of a cell.
BY_TEXT: dict[str, Callable[[str], str]] = {
    "int": to_int,
    "float": to_float,
    "dateTime": to_datetime,
    "date": to_date,
}


def json_column(column: str) -> Column:
    """A nested column as the compact JSON text it would arrive as."""
    return F.expr(f"CASE WHEN {column} IS NOT NULL THEN {nested_text(f'to_json({column})')} END")


def rows_to_table(lines: DataFrame, columns: Sequence[RemoteColumn], layout: Sequence[str] | None = None) -> DataFrame:
    """JSON row arrays (one per line in ``value``) as a typed table.

    ``layout`` names the array positions and defaults to the columns themselves. A missing position
    is NULL and further ones are ignored. A line that is not a JSON array fails the job: skipping it
    would publish a snapshot with rows missing.
    """
    position = {name: i for i, name in enumerate(layout or [c.name for c in columns])}

    def at(array: str, column: RemoteColumn) -> str:
        return f"get({array}, {position[column.name]})"

    def parsed(element: str, mode: str) -> str:
        return f"from_json(value, 'array<{element}>', map('mode', '{mode}'))"

    lines.sparkSession.conf.set(LAST_KEY_COUNTS, "true")
    truths = [c for c in columns if c.json_type == "boolean"]
    texts = [c for c in columns if c.json_type not in BY_TEXT and c.json_type != "boolean"]
    untold = " OR ".join(
        f"{at('texts', c)} RLIKE r'{pattern}'"
        for some, pattern in ((truths, UNTOLD_BOOLEAN), (texts, UNTOLD_TEXT))
        for c in some
    )
    again = f"from_json({strings_marked('value')}, 'array<string>')"
    # One projection per step, so that every line is parsed once, and once more only if need be.
    zeros = _outside_strings("value", "s", r"regexp_replace(s, r'(?<![0-9.eE])-0(?![0-9.eE])', '-0.0')")
    value = f"CASE WHEN value RLIKE r'{NEGATIVE_ZERO}' THEN {zeros} ELSE value END AS value"
    rows = lines.where("trim(value) <> ''").selectExpr(value).selectExpr("value", f"{parsed('string', 'FAILFAST')} AS texts")
    rows = rows.selectExpr("texts", f"CASE WHEN {untold or 'false'} THEN {again} END AS marked")

    def stored(column: RemoteColumn) -> str:
        text, is_string = at("texts", column), is_marked(at("marked", column))
        if column in truths:
            return to_boolean(text, is_string)
        if column in texts:
            return f"CASE WHEN {text} RLIKE r'{UNTOLD_TEXT}' AND NOT {is_string} THEN {json_text(text)} ELSE {text} END"
        return BY_TEXT[column.json_type](text)

    schema = snapshot_schema(columns)
    return rows.select([F.expr(stored(c)).alias(c.name, metadata=schema[i].metadata) for i, c in enumerate(columns)])
