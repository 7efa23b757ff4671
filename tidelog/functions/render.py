"""Row images to JSON text.

`row` and `primary_key` have no fixed schema and must keep column order and number spelling, so they are built from
JSON fragments (text) and never pass through a map or a variant. Names are quoted once, in the catalog: a *key* below
is a quoted name with its colon, e.g. `"user_id":`.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Row-event kinds of the log and the operation each one stands for.
OPERATIONS = {
    "INSERT": ["WRITE", "WRITE_V1"],
    "UPDATE": ["UPDATE", "UPDATE_V1", "PARTIAL_UPDATE"],
    "DELETE": ["DELETE", "DELETE_V1"],
}
ROW_EVENT_TYPES = [kind for kinds in OPERATIONS.values() for kind in kinds]

# Columns taken as the key, in this order, when no primary key is known.
FALLBACK_KEYS = ["id", "ID", "Id"]

# Control characters whose \u escape holds a hex letter; the escape is written in lower case.
_LETTER_ESCAPES = " ".join(f"u{code:04X}" for code in [0x0B, 0x0E, 0x0F, *range(0x1A, 0x20)])


def classify_operation(event_type: Column) -> Column:
    """INSERT, UPDATE or DELETE; null for an event without rows."""
    case = F.when(F.lit(False), F.lit(None).cast("string"))
    for operation, kinds in OPERATIONS.items():
        case = case.when(event_type.isin(kinds), F.lit(operation))
    return case


def json_string(text: Column) -> Column:
    """Text as a quoted JSON string; null as `null`."""
    # JSON text starts and ends with a quote (or is `null`), so only the brackets of the array are trimmed.
    quoted = F.trim(F.to_json(F.array(text)), F.lit("[]"))
    # An escape counts only behind an even number of backslashes.
    lowered = F.aggregate(
        F.split(F.lit(_LETTER_ESCAPES), " "),
        quoted,
        lambda done, code: F.regexp_replace(
            done, F.concat(F.lit(r"(?<!\\)((?:\\\\)*)\\"), code), F.concat(F.lit(r"$1\\"), F.lower(code))
        ),
    )
    return F.when(text.rlike(r"[\x0b\x0e\x0f\x1a-\x1f]"), lowered).otherwise(quoted)


def _shortest(number: Column) -> Column:
    """Text of a double with the fewest digits that read back as the same value."""
    text = number.cast("string")
    shortest = F.when(F.length(text) < 17, text)
    # Older Java runtimes may print one or two digits too many, so shorter texts are tried first.
    for decimals in (14, 15, 16):
        shorter = F.format_string(f"%.{decimals}e", number)
        tidy = F.regexp_replace(F.regexp_replace(shorter, r"e\+?(-?)0*(\d+)$", "E$1$2"), r"(\.\d+?)0+E", "$1E")
        shortest = shortest.when(shorter.cast("double") == number, tidy)
    return shortest.otherwise(text)


def json_number(number: Column) -> Column:
    """A double as a JSON number: plain decimals from 1e-5 up to 1e16, exponents outside, non-finite as `null`."""
    size = F.abs(number)
    # Spark's own text is already the JSON text in this range; all else is rare.
    usual = (size >= 1e-3) & (size < 1e7)
    text = _shortest(number)
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    exponent = F.lower(F.regexp_replace(text, r"\.0E", "E"))
    return (
        F.when(usual | (number == 0), number.cast("string"))
        .when(F.isnan(number) | number.isNull() | (size == float("inf")), F.lit("null"))
        .when((size >= 1e-5) & (size < 1e16), plain)
        .otherwise(exponent)
    )


def json_bytes(raw: Column) -> Column:
    """Bytes as a JSON string when they are UTF-8, else as `"0x…"`."""
    text = raw.cast("string")
    return F.when(F.is_valid_utf8(text), json_string(text)).otherwise(
        F.concat(F.lit('"0x'), F.lower(F.hex(raw)), F.lit('"'))
    )


_TWO_DIGITS = [f"{n:02d}" for n in range(100)]


def _two(number: Column, before: str = "") -> Column:
    """At least two digits behind a mark. A look-up in a constant list; general formatting costs many times as much."""
    texts = F.split(F.lit(" ".join(before + digits for digits in _TWO_DIGITS)), " ")
    return F.coalesce(F.get(texts, number), F.concat(F.lit(before), number.cast("string")))


def _year(number: Column) -> Column:
    return F.when(number < 1000, F.lpad(number.cast("string"), 4, "0")).otherwise(number.cast("string"))


def _micros(number: Column) -> Column:
    return F.lpad(number.cast("string"), 6, "0")


def _json_date(dt: Column) -> Column:
    midnight = (dt["h"] == 0) & (dt["mi"] == 0) & (dt["s"] == 0) & (dt["us"] == 0)
    day = [F.lit('"'), _year(dt["y"]), _two(dt["mo"], "-"), _two(dt["d"], "-")]
    clock = [_two(dt["h"], "T"), _two(dt["mi"], ":"), _two(dt["s"], ":"), F.lit("."), _micros(dt["us"])]
    return F.when(midnight, F.concat(*day, F.lit('"'))).otherwise(F.concat(*day, *clock, F.lit('"')))


def _json_time(tm: Column) -> Column:
    sign = F.when(tm["neg"], F.lit('"-')).otherwise(F.lit('"'))
    hours = tm["days"] * 24 + tm["h"]
    return F.concat(sign, _two(hours), _two(tm["mi"], ":"), _two(tm["s"], ":"), F.lit("."), _micros(tm["us"]), F.lit('"'))


def render_cell(cell: Column) -> Column:
    """One typed cell as a JSON fragment."""
    renderers = {
        "bytes": ("b", json_bytes),
        "int": ("i", lambda value: value.cast("string")),
        "double": ("d", json_number),
        "date": ("dt", _json_date),
        "time": ("tm", _json_time),
        "uint": ("u", lambda value: value.cast("string")),
        # Widened first: 0.1f is written as 0.10000000149011612.
        "float": ("f", lambda value: json_number(value.cast("double"))),
        "json": ("raw", lambda value: value),
    }
    fragment = F.when(F.lit(False), F.lit(""))
    for kind, (field, render) in renderers.items():
        # The null test comes first because it is cheaper than comparing the kind.
        fragment = fragment.when(cell[field].isNotNull() & (cell["kind"] == kind), render(cell[field]))
    return fragment.otherwise(F.lit("null"))


def fragments(cells: Column) -> Column:
    """A row image as JSON fragments in column order."""
    return F.transform(cells, render_cell)


def name_cells(cells: Column, names: Column) -> Column:
    """Names of the cells: the catalog's, or `col_i` where it has none. Surplus names are ignored."""
    return F.transform(
        cells,
        lambda cell, i: F.coalesce(F.nullif(F.get(names, i), F.lit("")), F.concat(F.lit("col_"), i.cast("string"))),
    )


def keys_of(names: Column) -> Column:
    """Catalog names as keys; an empty name has no key."""
    return F.transform(names, lambda n: F.when(n != "", F.concat(json_string(n), F.lit(":"))))


def all_distinct(keys: Column) -> Column:
    """Whether no key is missing or repeated."""
    return (F.size(F.array_distinct(keys)) == F.size(keys)) & ~F.exists(keys, lambda k: k.isNull())


def cell_keys(cells: Column, keys: Column) -> Column:
    """Keys of the cells, with `"col_i":` where the catalog has none (the keyed form of `name_cells`)."""
    return F.transform(
        cells, lambda cell, i: F.coalesce(F.get(keys, i), F.concat(F.lit('"col_'), i.cast("string"), F.lit('":')))
    )


def _last_index(keys: Column, key: Column) -> Column:
    """Index of the last cell with this key; past the end when there is none."""
    return (F.size(keys) - F.array_position(F.reverse(keys), key)).cast("int")


def object_json(keys: Column, values: Column, distinct: Column | None = None) -> Column:
    """JSON object of fragments in column order. A repeated key keeps its first place and its last value.

    `distinct` says where the keys are known to be distinct, which saves the test.
    """
    is_distinct = F.size(F.array_distinct(keys)) == F.size(keys)
    if distinct is not None:
        is_distinct = distinct | is_distinct
    members = F.when(is_distinct, F.zip_with(keys, values, lambda k, v: F.concat(k, v))).otherwise(
        F.transform(F.array_distinct(keys), lambda k: F.concat(k, F.get(values, _last_index(keys, k))))
    )
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is worked out once per row, however often it occurs in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def keyed_image_json(cells: Column, keys: Column) -> Column:
    """A row image as a JSON object under the catalog's keys (`keys_of`), which are best kept as a column of the catalog."""
    return _once(cell_keys(cells, keys), lambda own: object_json(own, fragments(cells)))


def row_image_json(cells: Column, names: Column) -> Column:
    """A row image as a JSON object under the catalog's names."""
    return _once(keys_of(names), lambda keys: keyed_image_json(cells, keys))


def row_envelope(operation: Column, before: Column, after: Column) -> Column:
    """The `row` object of a change event, from the JSON objects of its images."""
    return (
        F.when(operation == "INSERT", F.concat(F.lit('{"values":'), after, F.lit("}")))
        .when(operation == "DELETE", F.concat(F.lit('{"values":'), before, F.lit("}")))
        .otherwise(F.concat(F.lit('{"before_values":'), before, F.lit(',"after_values":'), after, F.lit("}")))
    )


def primary_key_json(keys: Column, values: Column, pk_keys: Column) -> Column:
    """The primary key of a row image (as keys and fragments) as JSON.

    One key column gives a scalar, several an object in key order (`null` where the image lacks one); without a known
    key the first of `id`, `ID`, `Id` that the image has, else `null`.
    """
    count = F.coalesce(F.size(pk_keys), F.lit(0))
    single = F.when(count == 1, F.get(pk_keys, F.lit(0)))
    for name in FALLBACK_KEYS:
        key = F.lit(f'"{name}":')
        single = single.when(F.array_contains(keys, key), key)

    def value(key: Column) -> Column:
        return F.coalesce(F.get(values, _last_index(keys, key)), F.lit("null"))

    composite = F.transform(pk_keys, lambda k: F.concat(k, value(k)))
    return F.when(count > 1, F.concat(F.lit("{"), F.array_join(composite, ","), F.lit("}"))).otherwise(value(single))


def null_if_empty(pk_columns: Column) -> Column:
    """The key columns, or null when there are none."""
    return F.when(F.size(pk_columns) > 0, pk_columns)


def json_string_list(items: Column) -> Column:
    """A list of texts as a JSON array; null as `null`."""
    return F.coalesce(
        F.concat(F.lit("["), F.array_join(F.transform(items, json_string), ","), F.lit("]")), F.lit("null")
    )
