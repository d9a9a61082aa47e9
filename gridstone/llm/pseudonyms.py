"""Personal numbers and dates replaced by pseudonyms of the same format.

Card numbers (13 to 19 digits that pass the Luhn check), telephone numbers, social security numbers,
IPv4 addresses and calendar dates are found by pattern, validated, and sent through a keyed Feistel
network over their own format: digits stay digits, separators stay, a card keeps a right check digit, an
address stays an address and a date a date. The network is a permutation, so equal values stay linked
across documents, different ones stay different, and who holds the key can undo it. An e-mail address
is no number; it becomes an address made from its keyed hash, equal for equal addresses.

All of it is DataFrame expressions. Nulls: a null text stays null with no replacements. Every
replacement depends on the value and the key alone, so repeated rows come out equal. Other columns are
kept as they are. An empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, N_DAYS, DAY_SIDE = "1900-01-01", 73049, 271  # days of 1900 to 2099; the network works on 271 x 271
# All other days of the years 1 to 9999 have a network of their own.
DAY_ONE, ALL_DAYS, ALL_SIDE, BEFORE = "0001-01-01", 3652059, 1912, 693595

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}[./]\d{2}[./]\d{4})"
SOCIAL = r"\d{3}-\d{2}-\d{4}"
PHONE = r"(?:\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})"
ADDRESS = r"(?:\d{1,3}\.){3}\d{1,3}"
# Groups of digits with single spaces or hyphens between them, 13 digits at least; searched group by group.
RUN = r"(?=\d(?:[ -]?\d){12})\d++(?![\p{L}\p{N}])(?:[ -]\d++(?![\p{L}\p{N}]|\.\d))*+"
PREFIX = r"\+?1-"
FOUND = (
    rf"{EMAIL}|(?<![\p{{L}}\p{{N}}])(?<!\d[.-])(?:(?:{DATE}(?=T\d)|(?:{DATE}|{SOCIAL}|(?:{PREFIX})?{PHONE}|{ADDRESS})(?![\p{{L}}\p{{N}}]))(?![.-]\d)|{RUN})"
    rf"|(?<![\p{{L}}\p{{N}}])\+1-{PHONE}(?![\p{{L}}\p{{N}}])(?![.-]\d)"
)
MOST_GROUPS = 19


def _number(value: Column, key: str, turn: Column, most: Column) -> Column:
    """A keyed number below ``most``."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), turn.cast("string"), most.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % most


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str) -> Column:
    """Permutation of the pairs (left, right) below the two sizes, as a struct of both."""

    def step(state: Column, turn: Column) -> Column:
        l, r = state["left"], state["right"]
        return F.when(turn % 2 == 0, F.struct(((l + _number(r, key, turn, left_size)) % left_size).alias("left"), r.alias("right"))).otherwise(
            F.struct(l.alias("left"), ((r + _number(l, key, turn, right_size)) % right_size).alias("right")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("left"), right.cast("long").alias("right")), step)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str) -> Column:
    """Permutation of the digit strings of a length, at most 19 digits."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    rest = n - half
    left, right = F.substring(digits, F.lit(1), half).cast("long"), F.substring(digits, half + 1, rest).cast("long")
    return _let(feistel(left, right, _power(half), _power(rest), key), lambda s: F.concat(F.lpad(s["left"].cast("string"), half, "0"), F.lpad(s["right"].cast("string"), rest, "0")))


def _refilled(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced in turn."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(state: Column, c: Column) -> Column:
        is_digit = c.rlike(r"^\d$")
        return F.struct(F.concat(state["out"], F.when(is_digit, F.substring(digits, state["n"] + 1, F.lit(1))).otherwise(c)).alias("out"), (state["n"] + is_digit.cast("int")).alias("n"))

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum when the last digit is not doubled."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: _let(c.cast("int") * (1 + i % 2), lambda v: v - F.when(v > 9, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0)))


def _is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0)


def _card(hit: Column, key: str) -> Column:
    def replaced(digits: Column) -> Column:
        body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key)
        whole = _let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(_is_card(digits), _refilled(hit, whole))

    return _let(_digits(hit), replaced)


def _address(hit: Column, key: str) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda p: p.cast("long"))

    def replaced(p: Column) -> Column:
        new = feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key)
        text = _let(new, lambda s: F.concat_ws(".", *(F.floor(s[x] / 256).cast("string") if high else (s[x] % 256).cast("string") for x in ("left", "right") for high in (True, False))))
        return F.when(F.forall(p, lambda x: x <= 255), text)

    return _let(parts, replaced)


def _date(hit: Column, key: str) -> Column:
    """Year first, or day before month, or month before day where only that is a date."""
    formats = [("yyyy-MM-dd", r"^\d{4}-"), ("yyyy/MM/dd", r"^\d{4}/"), ("dd.MM.yyyy", r"^..\."), ("dd/MM/yyyy", r"^../"), ("MM/dd/yyyy", r"^../")]
    return F.coalesce(*(F.when(hit.rlike(shape), _moved(hit, form, key)) for form, shape in formats))


def _moved(hit: Column, form: str, key: str) -> Column:
    def walk(day: Column, first: str, side: int, key: str, inside) -> Column:
        def once(value: Column) -> Column:
            return _let(feistel(F.floor(value / side), value % side, F.lit(side), F.lit(side), key), lambda s: s["left"] * side + s["right"])

        # Steps outside the calendar go on until they are back in it.
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(24)), once(day), lambda v, _: F.when(inside(v), v).otherwise(once(v)))
        return F.when(inside(day), _let(walked, lambda v: F.date_format(F.date_add(F.lit(first).cast("date"), v.cast("int")), form)))

    near = lambda v: v.between(0, N_DAYS - 1)
    far = lambda v: v.between(0, ALL_DAYS - 1) & ~v.between(BEFORE, BEFORE + N_DAYS - 1)
    days = lambda first: F.datediff(F.try_to_timestamp(hit, F.lit(form)).cast("date"), F.lit(first).cast("date")).cast("long")
    return F.coalesce(_let(days(FIRST_DAY), lambda d: walk(d, FIRST_DAY, DAY_SIDE, key, near)), _let(days(DAY_ONE), lambda d: walk(d, DAY_ONE, ALL_SIDE, f"{key}:far", far)))


def _email(hit: Column, key: str) -> Column:
    return F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lower(hit)), 256), 1, 16), F.lit("@masked.invalid"))


def pseudonym(hit: Column, key: str) -> Column:
    """The pseudonym of a found value, or null where it is not a valid one."""
    whole = lambda p: f"^{p}$"
    plain = F.regexp_replace(hit, f"^{PREFIX}(?=.{{9}})", "")
    number = lambda h: _refilled(h, permuted_digits(_digits(h), key))
    return (
        F.when(F.contains(hit, F.lit("@")), _email(hit, key)).when(hit.rlike(whole(DATE)), _date(hit, key))
        .when(hit.rlike(whole(SOCIAL)) | hit.rlike(whole(PHONE)), number(hit))
        .when(hit.rlike(whole(f"{PREFIX}{PHONE}")), F.concat(F.regexp_extract(hit, f"^({PREFIX})", 1), number(plain)))
        .when(hit.rlike(whole(ADDRESS)), _address(hit, key)).otherwise(_card(hit, key))
    )


def segments(hit: Column) -> Column:
    """A found value in pieces: of a run of digit groups, from the left, dates, social security and telephone
    numbers, else the longest card that starts at a group, and what is between. Anything else is one piece."""
    parts = F.regexp_extract_all(hit, F.lit(r"(\d+|[ -])"), F.lit(0))

    def cut(parts: Column) -> Column:
        def joined(i: Column, n: Column) -> Column:
            return F.array_join(F.slice(parts, i + 1, n), "")

        def taken(i: Column) -> Column:
            """How many parts the value that starts at a group has; 1 where none does."""
            at = lambda j: F.coalesce(F.when(j >= 0, F.get(parts, j)), F.lit(""))
            three = joined(i, F.lit(5))
            date = three.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(three, F.lit("yyyy-MM-dd")).isNotNull()
            shaped = (at(i - 1) != "-") & (at(i + 5) != "-") & (date | three.rlike(f"^(?:{SOCIAL}|{PHONE})$"))
            five = joined(i, F.lit(7))
            called = (at(i - 1) != "-") & (at(i + 7) != "-") & five.rlike(f"^1-{PHONE}$")
            ends = F.filter(F.sequence(F.lit(2 * MOST_GROUPS - 1), F.lit(1), F.lit(-2)), lambda n: (i + n <= F.size(parts)) & _let(_digits(joined(i, n)), _is_card))
            return F.when(shaped, 5).when(called, 7).otherwise(F.coalesce(F.get(ends, F.lit(0)), F.lit(1)))

        def step(state: Column, i: Column) -> Column:
            n = F.when(i < state["next"], 0).when(i % 2 == 1, 1).otherwise(taken(i))
            return _let(n, lambda n: F.struct(F.when(n > 0, i + n).otherwise(state["next"]).alias("next"), F.when(n > 0, F.concat(state["cut"], F.array(joined(i, n)))).otherwise(state["cut"]).alias("cut")))

        start = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("cut"))
        return F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), start, step, lambda s: s["cut"])

    return F.when(hit.rlike(r"^\d+(?:[ -]\d+)*+$") & (F.length(_digits(hit)) >= 13), _let(parts, cut)).otherwise(F.array(hit))


def _put_together(pieces: Column) -> Column:
    """A found value with its pieces replaced, and how many were."""
    return F.struct(F.array_join(F.transform(pieces, lambda p: F.coalesce(p["new"], p["old"])), "").alias("new"), F.size(F.filter(pieces, lambda p: p["new"].isNotNull())).alias("n"))


def replace_personal(documents: DataFrame, key: str, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """The rows with personal values of ``text`` replaced, and how many were, as column ``count``."""
    t = F.col(text)
    # Texts without an at sign or two digits near each other hold nothing; most stop here.
    may = t.rlike(r"@|\d[\d./ -]{0,3}\d")
    hits = F.transform(F.regexp_extract_all(t, F.lit(f"({FOUND})"), F.lit(0)), lambda h: _let(F.transform(segments(h), lambda p: F.struct(p.alias("old"), pseudonym(p, key).alias("new"))), _put_together))
    # The array passes a generator, so that every value is worked out once and not for each use.
    held = documents.withColumn("__hits", F.when(may, hits)).select("*", F.explode(F.array(F.col("__hits"))).alias("__found")).drop("__hits")
    pieces = F.split(t, FOUND, -1)
    new = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(F.col("__found"), i)["new"], F.lit("")))), "")
    replaced = F.coalesce(F.aggregate("__found", F.lit(0), lambda n, h: n + h["n"]), F.lit(0))
    some = F.size("__found") > 0
    kept = [F.when(some, new).otherwise(t).alias(text) if c == text else F.col(f"`{c}`") for c in documents.columns]
    return held.select(*kept, F.when(some, replaced).otherwise(0).alias(count))
