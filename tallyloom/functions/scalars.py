"""Column expressions: decoding, casting, money measures, dates, keys, canonical text.

Every function takes and returns ``Column``; all run inside Catalyst.  The name in brackets is the
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The reference that points nowhere.
ZERO_UUID = "00000000-0000-0000-0000-000000000000"
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
BUSINESS_ZONE = "Asia/Almaty"
#: The words that stand for true and false.
TRUE_WORDS = ("true", "t", "yes", "y", "1", "да")
FALSE_WORDS = ("false", "f", "no", "n", "0", "нет")
#: What the names of returns, sales and till receipts hold.
SIGN_WORDS = ("Возврат", "Реализация", "ЧекККМ")
#: Fixed value: the day from which bonus sales are counted the new way.
BONUS_START = "2022-10-12"
#: Types that ``typed`` knows, with what a missing value becomes in a table without nulls.
DEFAULTS = {"bigint": 0, "int": 0, "smallint": 0, "double": 0.0, "decimal(18,4)": 0, "string": "", "boolean": False, "timestamp": "1970-01-01 00:00:00", "date": "1970-01-01"}


def dashed(h: Column) -> Column:
    """32 hex digits with the dashes of a uuid; other text stays."""
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def binary_to_uuid(b: Column) -> Column:
    """16 bytes in the accounting system's order to a canonical uuid; null for any other length [SCL-01]."""
    h = F.lower(F.hex(b))
    return F.when(F.octet_length(b) == 16, F.concat_ws("-", F.substring(h, 25, 8), F.substring(h, 21, 4), F.substring(h, 17, 4), F.substring(h, 1, 4), F.substring(h, 5, 12)))


def uuid_to_binary(u: Column) -> Column:
    """The inverse of ``binary_to_uuid``; null for what is no uuid [SCL-02]."""
    h = parse_uuid(u)
    return F.unhex(F.concat(F.substring(h, 20, 4), F.substring(h, 25, 12), F.substring(h, 15, 4), F.substring(h, 10, 4), F.substring(h, 1, 8)))


def binary_to_hex(b: Column) -> Column:
    """``0x`` and upper-case digits [SCL-03]."""
    return F.concat(F.lit("0x"), F.hex(b))


def parse_uuid(s: Column) -> Column:
    """Lenient: trims, drops ``0x``, dashes and spaces, any case; 32 hex digits or null [SCL-04]."""
    h = F.regexp_replace(F.regexp_replace(F.lower(F.trim(s)), "^0x", ""), "[- ]", "")
    return F.when(F.rlike(h, F.lit("^[0-9a-f]{32}$")), dashed(h))


def norm_key(s: Column) -> Column:
    """Canonical uuid, or null if empty, invalid or the zero reference [SCL-05]."""
    return F.nullif(parse_uuid(s), F.lit(ZERO_UUID))


def is_uuid(s: Column) -> Column:
    """[FLT-08]"""
    return F.coalesce(F.rlike(F.lower(F.trim(s)), F.lit(UUID_PATTERN)), F.lit(False))


def binary_to_int(b: Column, little: bool = False) -> Column:
    """4 bytes as an unsigned number; null for any other length [SCL-06]."""
    h = F.hex(b)
    if little:
        h = F.concat(*[F.substring(h, k, 2) for k in (7, 5, 3, 1)])
    return F.when(F.octet_length(b) == 4, F.conv(h, 16, 10).cast("bigint"))


def binary_to_bool(b: Column) -> Column:
    """One byte, not zero; null for any other length [SCL-07]."""
    return F.when(F.octet_length(b) == 1, F.hex(b) != "00")


def binary_auto(b: Column) -> Column:
    """By length: uuid, number or truth value, as text; other lengths null [SCL-08]."""
    n = F.octet_length(b)
    return F.when(n == 16, binary_to_uuid(b)).when(n == 4, binary_to_int(b).cast("string")).when(n == 1, binary_to_bool(b).cast("string"))


def invert_bool(c: Column) -> Column:
    """[SCL-09]"""
    return ~c


def lookup(code: Column, names: Mapping[str, str]) -> Column:
    """The code's name; an unknown code stays as text [SCL-10]."""
    s = code.cast("string")
    if not names:
        return s
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), s), s)


def fix_year(ts: Column, offset: int = 2000, after: int = 3000) -> Column:
    """Takes ``offset`` years off dates beyond year ``after``; 29 February without one becomes 1 March [SCL-11]."""
    y = F.year(ts) - F.lit(offset)
    moved = F.coalesce(
        F.try_make_timestamp(y, F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.date_format(ts, "ss.SSSSSS").cast("decimal(8,6)")),
        F.try_make_timestamp(y, F.lit(3), F.lit(1), F.hour(ts), F.minute(ts), F.date_format(ts, "ss.SSSSSS").cast("decimal(8,6)")),
    )
    return F.when(F.year(ts) > after, moved).otherwise(ts)


def fix_year_text(s: Column, offset: int = 2000, after: int = 3000) -> Column:
    """The same on text that begins with a year; other text stays [SCL-12]."""
    y = F.nullif(F.regexp_extract(s, r"^(\d+)-", 1), F.lit("")).try_cast("int")
    return F.when(y > after, F.concat((y - offset).cast("string"), F.regexp_replace(s, r"^\d+", ""))).otherwise(s)


def parse_date(s: Column) -> Column:
    """A timestamp from text with either calendar, or null [SCL-13]."""
    return fix_year_text(s).try_cast("timestamp")


def to_local(ts: Column, zone: str = BUSINESS_ZONE) -> Column:
    """UTC to naive business time [SCL-14]."""
    return F.from_utc_timestamp(ts, zone)


def to_int(s: Column) -> Column:
    """Whole numbers in text; anything else null [SCL-15]."""
    t = F.trim(s.cast("string"))
    return F.when(F.rlike(t, F.lit(r"^[+-]?\d+$")), t.try_cast("bigint"))


def to_float(s: Column) -> Column:
    return s.try_cast("double")


def to_decimal(s: Column, scale: int = 2) -> Column:
    """Half-even rounding; null on failure [SCL-16]."""
    return F.bround(s.cast("string").try_cast("decimal(28,10)"), scale).cast(f"decimal(18,{scale})")


def to_bool(s: Column) -> Column:
    """Truth words in text, and whether a number is not 0; anything else null [SCL-17]."""
    kind, t = F.typeof(s), F.lower(F.trim(s.cast("string")))
    number = kind.isin("tinyint", "smallint", "int", "bigint", "float", "double") | F.startswith(kind, F.lit("decimal"))
    return F.when(number, s.cast("string").try_cast("double") != 0).when(t.isin(*TRUE_WORDS), True).when(t.isin(*FALSE_WORDS), False)


CASTS: dict[str, Callable[[Column], Column]] = {"int": to_int, "float": to_float, "str": lambda c: c.cast("string"), "decimal": to_decimal, "bool": to_bool, "date": lambda c: F.to_date(parse_date(c.cast("string")))}


def cast(c: Column, kind: str) -> Column:
    """By kind; an unknown kind leaves the column [SCL-18]."""
    return CASTS.get(kind, lambda x: x)(c)


def doc_sign(kind: Column, operation: Column, words: tuple[str, str, str] = SIGN_WORDS) -> Column:
    """-1 for returns, 1 for sales, for the till -1 where the operation is a return and else 1, else 0 [SCL-21].

    ``words`` are what the names of returns, sales and till receipts hold, letter by letter.
    """
    gone, sold, till = (F.lit(w) for w in words)
    k, o = F.coalesce(kind.cast("string"), F.lit("")), F.coalesce(operation.cast("string"), F.lit(""))
    return F.when(F.contains(k, gone), -1).when(F.contains(k, sold), 1).when(F.contains(k, till), F.when(F.contains(o, gone), -1).otherwise(1)).otherwise(0)


def _zero(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def sales_with_vat(cost: Column, vat: Column) -> Column:
    """The cost where VAT is in it, else the cost and 12 % [SCL-20]."""
    return F.when(_zero(vat) > 0, _zero(cost)).otherwise(_zero(cost) * 1.12)


def sales_without_vat(cost: Column, vat: Column, full: Column, used: Column, bonus: Column, flag: Column, period: Column, sign: Column) -> Column:
    """Net sales; flagged bonus sales from ``BONUS_START`` on add the bonuses used and take VAT off the full price [SCL-20]."""
    new_way = (period >= F.lit(BONUS_START).cast("timestamp")) & F.coalesce(flag, F.lit(False)) & (_zero(bonus) > 0)
    return F.when(new_way, sign * _zero(used) + _zero(cost) - F.bround(_zero(full) / 1.12 * 0.12, 2)).otherwise(_zero(cost) - _zero(vat))


def signed(amount: Column, sign: Column) -> Column:
    """Bonuses earned or used, or any amount, by document sign [SCL-22, SCL-24]."""
    return sign * _zero(amount)


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or missing [SCL-23]."""
    return F.coalesce(F.when(b != 0, a / F.nullif(b, F.lit(0))), F.lit(0.0))


def weighted(total: Column, weight: Column) -> Column:
    """total / weight, null where the weight is 0 [SCL-24]."""
    return total / F.nullif(weight, F.lit(0))


def width_bucket(c: Column, thresholds: Sequence[float]) -> Column:
    """How many thresholds the value has reached [SCL-25]."""
    return F.when(c.isNotNull(), F.size(F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: t <= c)))


def checkpoint_field(text: Column, name: str) -> Column:
    """A field of ``name=value; name=value`` text, or null [SCL-26]."""
    return F.nullif(F.regexp_extract(text, rf"(?:^|;\s*){name}=([^;]*)", 1), F.lit(""))


def partition_key(ts: Column, pattern: str = "yyyyMM") -> Column:
    """[SCL-27]"""
    return F.date_format(ts, pattern).cast("int")


def partition_start(key: Column) -> Column:
    """First day of month ``yyyymm`` [SCL-28]."""
    return F.to_date(key.cast("string"), "yyyyMM")


def months_of(year: int, now: Column) -> Column:
    """Months of a year as ``yyyymm`` numbers, up to this one; in January the December before it too [SCL-29]."""
    first, this = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.trunc(now, "month")
    begin = F.when(this == first, F.add_months(first, -1)).otherwise(first)
    months = F.sequence(begin, F.least(this, F.add_months(first, 11)), F.expr("INTERVAL 1 MONTH"))
    return F.when(this >= first, F.transform(months, lambda day: partition_key(day))).otherwise(F.array().cast("array<int>"))


def hot_months(now: Column) -> Column:
    """Last month and this one as ``yyyymm`` numbers [SCL-29, STR-08]."""
    return F.array(partition_key(F.add_months(now, -1)), partition_key(now))


def ref_if(ref: Column, code: Column, wanted: int) -> Column:
    """The reference where its type code is the wanted one, else null [FLT-13]."""
    return F.when(code == wanted, ref)


def safe_sum(c: Column) -> Column:
    """Sum of what is a number: NaN counts as missing [AGG-13]."""
    return F.sum(F.when(~F.isnan(c), c))


def partition_end(key: Column) -> Column:
    """First day after it [SCL-28]."""
    return F.add_months(partition_start(key), 1)


def canonical(*columns: Column) -> Column:
    """One text for a row, parts divided by a bar; missing values count as empty, uuids and texts as they are [SCL-30]."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def metric(c: Column) -> Column:
    """Comparable normal form of a measure: decimal(38,8), null as 0 [SCL-31]."""
    return F.coalesce(c.cast("decimal(38,8)"), F.lit(0).cast("decimal(38,8)"))


def deviation(a: Column, b: Column) -> Column:
    """Relative deviation in per cent, 4 places [SCL-32]."""
    a, b = _zero(a), _zero(b)
    return F.round(F.abs(a - b) / F.greatest(F.abs(a), F.lit(1.0)) * 100, 4)


def is_empty_ref(c: Column) -> Column:
    """Missing, empty or the zero reference [SCL-37]."""
    return F.coalesce(F.trim(c).isin("", ZERO_UUID), F.lit(True))


def pack_refs(refs: Mapping[str, Column]) -> Column:
    """One JSON object of the references that are set; ``name.part`` columns nest, and a nested object without ``uid`` goes [SCL-33]."""
    flat = {k: F.when(~is_empty_ref(c.cast("string")), c.cast("string")) for k, c in refs.items() if "." not in k}
    nested: dict[str, dict[str, Column]] = {}
    for k, c in refs.items():
        if "." in k:
            head, part = k.split(".", 1)
            nested.setdefault(head, {})[part] = F.when(~is_empty_ref(c.cast("string")), c.cast("string"))
    parts = [c.alias(k) for k, c in flat.items()]
    parts += [F.when(p["uid"].isNotNull(), F.struct(*[c.alias(x) for x, c in p.items()])).alias(k) for k, p in nested.items() if "uid" in p]
    return F.to_json(F.struct(*parts))


def ref_uid(refs: Column, key: str) -> Column:
    """The reference's uuid, plain or nested [SCL-34]."""
    nested, plain = F.get_json_object(refs, f"$.{key}.uid"), F.get_json_object(refs, f"$.{key}")
    return F.coalesce(nested, F.when(~F.startswith(plain, F.lit("{")), plain))


def ref_type(refs: Column, key: str) -> Column:
    return F.get_json_object(refs, f"$.{key}.type")


def set_ref(refs: Column, key: str, value: Column) -> Column:
    """The flat object with one key put in its place, or taken out for null [SCL-35]."""
    old = F.coalesce(F.from_json(refs, "map<string,string>"), F.from_json(F.lit("{}"), "map<string,string>"))
    others = F.map_filter(old, lambda k, _: k != key)
    return F.to_json(F.when(value.isNull(), others).otherwise(F.map_concat(others, F.create_map(F.lit(key), value))))


def hex_dump(columns: Mapping[str, Column]) -> Column:
    """JSON of binary columns as hex [SCL-36]."""
    return F.to_json(F.struct(*[binary_to_hex(c).alias(k) for k, c in columns.items()]))


def tidy(s: Column) -> Column:
    """No-break spaces as spaces, runs of white space as one, trimmed [SCL-38]."""
    return F.trim(F.regexp_replace(F.translate(s, "\u00a0", " "), r"\s+", " "))


def is_complete(columns: Sequence[Column]) -> Column:
    """Whether any display column has text; with none to show, always [SCL-39]."""
    out = F.lit(not columns)
    for c in columns:
        out = out | F.coalesce(F.trim(c) != "", F.lit(False))
    return out


def content_hash(*columns: Column) -> Column:
    """A row's content as a number that may be summed [SCL-40]."""
    return F.xxhash64(*columns).cast("decimal(38,0)")


def finite(c: Column) -> Column:
    """NaN and infinities as null; zero stays [PRJ-09]."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def typed(c: Column, kind: str) -> Column:
    """A value of ``kind`` or its default, for tables without nulls; times are cut to the second [PRJ-08]."""
    default = F.lit(DEFAULTS[kind]).cast(kind)
    value = c.try_cast(kind) if kind != "timestamp" else F.date_trunc("second", c.try_cast("timestamp"))
    return F.coalesce(value, default)
