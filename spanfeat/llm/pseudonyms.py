"""Format-preserving pseudonyms for validated values, in DataFrame functions only.

Each value is turned into an array of small numbers, permuted by a keyed Feistel network,
and written back in its own format, so equal values stay equal in every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.common import shielded

# Formats recognised.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}"
PHONE = r"\+?[0-9]{1,2}[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|\+?[0-9]{0,2}[ .-]?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
EDGE_L, EDGE_R = r"(?<![0-9A-Za-z.@+-])", r"(?![0-9A-Za-z@]|[.-][0-9])"
# Digits, blanks and hyphens with at least 13 digits, up to a group border; cards are looked for inside.
RUN = r"(?=(?:[ -]*[0-9]){13})[0-9][0-9 -]{11,}[0-9](?![A-Za-z0-9._%+-]*@)"
INNER = f"{EMAIL}|{EDGE_L}(?:{IPV4}|{PHONE}|{DATE}|{SSN}){EDGE_R}"
PATTERN = f"{EMAIL}|{EDGE_L}(?:{IPV4}|{PHONE}|{DATE}|{SSN}|{RUN}){EDGE_R}"
# Group lengths of printed cards; they win over other windows of a run.
LAYOUT = r"^(?:1[3-9]|4-4-4-4|4-6-5|4-6-4|4-4-4-4-3|4-4-5)$"

ROUNDS = 10
# Days 1900-01-01 up to 270 * 271 days later.
DAY_SIDES = (270, 271)
LETTERS = "0123456789abcdefghijklmnopqrstuvwxyz"


def feistel(values: Column, even: int, odd: int, key: str, label: str) -> Column:
    """Keyed permutation of arrays of numbers.

    The first half counts modulo ``even`` and the second modulo ``odd``. Each round adds a
    keyed stream of the second half to the first and swaps them; an even number of rounds
    brings each half back to its own modulus.
    """
    half = F.floor(F.size(values) / 2).cast("int")

    def step(state, i):
        mod = F.when(i % 2 == 0, F.lit(even)).otherwise(F.lit(odd))
        seed = F.concat_ws("|", F.lit(key), F.lit(label), i.cast("string"), F.array_join(state["b"].cast("array<string>"), ","))
        stream = F.sha2(seed, 256)
        new = F.transform(
            state["a"],
            lambda x, j: (
                (x + F.conv(F.substring(stream, j % 15 * 4 + 1, 7), 16, 10).cast("long") + j) % mod
            ).cast("int"),
        )
        return F.struct(state["b"].alias("a"), new.alias("b"))

    start = F.struct(
        F.slice(values, F.lit(1), half).alias("a"),
        F.slice(values, half + 1, F.size(values) - half).alias("b"),
    )
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return F.concat(done["a"], done["b"])


def _digits(text: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(text, "[^0-9]", ""), ""), lambda c: c.cast("int"))


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum; the last digit counts once."""
    n = F.size(digits)
    parts = F.transform(
        digits,
        lambda d, i: F.when((n - i) % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x)


def _refill(text: Column, digits: Column) -> Column:
    """Put digits in the places where ``text`` has digits."""
    state = F.aggregate(
        F.split(text, ""),
        F.struct(F.lit("").alias("s"), F.lit(1).alias("k")),
        lambda acc, c: F.when(
            c.rlike("^[0-9]$"),
            F.struct(F.concat(acc["s"], F.element_at(digits, acc["k"]).cast("string")).alias("s"), (acc["k"] + 1).alias("k")),
        ).otherwise(F.struct(F.concat(acc["s"], c).alias("s"), acc["k"].alias("k"))),
    )
    return state["s"]


def _last(text: Column, n: int) -> Column:
    return F.slice(_digits(text), F.size(_digits(text)) - (n - 1), n)


def _tail_refill(text: Column, n: int, new: Column) -> Column:
    """Replace the last n digits, keep the digits before them (a country code)."""
    d = _digits(text)
    return _refill(text, F.concat(F.slice(d, F.lit(1), F.size(d) - n), new))


def kind_of(value: Column) -> Column:
    """email, ipv4, phone, date, ssn or card; null where the value does not validate."""
    digits = _digits(value)
    day = F.try_to_date(value, "yyyy-MM-dd")
    low, high = F.lit("1900-01-01").cast("date"), F.date_add(F.lit("1900-01-01").cast("date"), DAY_SIDES[0] * DAY_SIDES[1] - 1)
    return (
        F.when(value.rlike(f"^(?:{EMAIL})$"), "email")
        .when(value.rlike(f"^(?:{IPV4})$"), "ipv4")
        .when(value.rlike(f"^(?:{DATE})$"), F.when(day.between(low, high), "date"))
        .when(value.rlike(f"^(?:{SSN})$"), "ssn")
        .when(value.rlike(f"^(?:{CARD})$") & (_luhn_sum(digits) % 10 == 0), "card")
        .when(value.rlike(f"^(?:{PHONE})$") & (F.size(digits) >= 10), "phone")
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The value's pseudonym in the same format; values without a kind stay."""
    body = F.slice(_digits(value), F.lit(1), F.size(_digits(value)) - 1)
    card = feistel(body, 10, 10, key, "card")
    check = (10 - _luhn_sum(F.concat(card, F.array(F.lit(0)))) % 10) % 10
    octets = F.transform(F.split(value, r"\."), lambda c: c.cast("int"))
    day = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))
    sides = feistel(
        F.array(F.floor(day / DAY_SIDES[1]).cast("int"), (day % DAY_SIDES[1]).cast("int")), *DAY_SIDES, key, "date"
    )
    new_day = F.date_add(F.lit("1900-01-01").cast("date"), F.element_at(sides, 1) * DAY_SIDES[1] + F.element_at(sides, 2))
    name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    letters = F.transform(F.split(F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", "")), ""), _place)
    masked = feistel(letters, 36, 36, key, "email")
    email = F.concat(
        F.aggregate(
            F.split(name, ""),
            F.struct(F.lit("").alias("s"), F.lit(1).alias("k")),
            lambda acc, c: F.when(
                c.rlike("^[A-Za-z0-9]$"),
                F.struct(
                    F.concat(acc["s"], F.substring(F.lit(LETTERS), F.element_at(masked, acc["k"]) + 1, F.lit(1))).alias("s"),
                    (acc["k"] + 1).alias("k"),
                ),
            ).otherwise(F.struct(F.concat(acc["s"], c).alias("s"), acc["k"].alias("k"))),
        )["s"],
        F.lit("@"),
        host,
    )
    return (
        F.when(kind == "card", _refill(value, F.concat(card, F.array(check.cast("int")))))
        .when(kind == "ipv4", F.array_join(feistel(octets, 256, 256, key, "ipv4").cast("array<string>"), "."))
        .when(kind == "phone", _tail_refill(value, 10, feistel(_last(value, 10), 10, 10, key, "phone")))
        .when(kind == "ssn", _refill(value, feistel(_digits(value), 10, 10, key, "ssn")))
        .when(kind == "date", F.date_format(new_day, "yyyy-MM-dd"))
        .when(kind == "email", email)
        .otherwise(value)
    )


def _place(c: Column) -> Column:
    """Position of a character in LETTERS."""
    code = F.ascii(c)
    return F.when(code >= 97, code - 87).otherwise(code - 48).cast("int")


def _with(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _piece(value: Column, kind: Column) -> Column:
    return F.struct(value.alias("v"), kind.cast("string").alias("k"))


def _plain(text: Column) -> Column:
    """Pieces (v, k) of a text without cards."""
    rest, found = F.split(text, INNER, -1), F.regexp_extract_all(text, F.lit(INNER), F.lit(0))
    both = F.zip_with(rest, found, lambda r, x: F.array(_piece(r, F.lit(None)), _piece(x, kind_of(x))))
    return F.filter(F.flatten(both), lambda p: p["v"] != "")


def _cards(run: Column) -> Column:
    """Pieces (v, k) of a run of digit groups that is not a card as a whole.

    Every window of 13 to 19 digits between group borders, with one separator throughout,
    is tested; of windows that overlap, printed layouts, then longer, then earlier ones win.
    """
    groups, seps = F.regexp_extract_all(run, F.lit("([0-9]+)"), F.lit(1)), F.split(run, "[0-9]+", -1)
    return _with(F.struct(groups.alias("g"), seps.alias("s")), lambda x: _windows(x["g"], x["s"]))


def _windows(groups: Column, seps: Column) -> Column:
    n = F.size(groups)
    tokens = F.slice(F.flatten(F.zip_with(seps, groups, lambda s, g: F.array(s, F.coalesce(g, F.lit(""))))), F.lit(2), 2 * n - 1)

    def window(i, j):
        inside = F.slice(groups, i + 1, j - i + 1)
        layout = F.array_join(F.transform(inside, lambda g: F.length(g).cast("string")), "-")
        gaps = F.array_join(F.array_distinct(F.slice(seps, i + 2, j - i)), "|")
        return F.struct(
            F.when(layout.rlike(LAYOUT), 0).otherwise(1).alias("rank"), (-F.length(F.array_join(inside, ""))).alias("size"),
            i.alias("i"), j.alias("j"), F.array_join(inside, "").alias("d"), gaps.alias("gaps"),
        )

    windows = F.flatten(F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.transform(F.sequence(i, F.least(i + 18, n - 1)), lambda j: window(i, j)),
    ))
    valid = F.filter(
        windows, lambda w: w["size"].between(-19, -13) & w["gaps"].isin("", " ", "-") & (_luhn_sum(_digits(w["d"])) % 10 == 0)
    )
    spans = F.aggregate(
        F.array_sort(valid),
        F.array().cast("array<struct<i:int,j:int>>"),
        lambda kept, w: F.when(F.exists(kept, lambda o: (o["i"] <= w["j"]) & (w["i"] <= o["j"])), kept).otherwise(
            F.concat(kept, F.array(F.struct(w["i"].alias("i"), w["j"].alias("j"))))
        ),
    )

    return _with(F.struct(tokens.alias("t"), F.array_sort(spans).alias("w")), lambda x: _cut(x["t"], x["w"]))


def _cut(tokens: Column, spans: Column) -> Column:
    """Pieces (v, k) of groups and separators in turn, of which ``spans`` are cards."""

    def text(a, b):
        return F.array_join(F.slice(tokens, a + 1, b - a), "")

    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<v:string,k:string>>").alias("out")),
        lambda acc, w: F.struct(
            (2 * w["j"] + 1).alias("at"),
            F.concat(
                acc["out"], _plain(text(acc["at"], 2 * w["i"])),
                F.array(_piece(text(2 * w["i"], 2 * w["j"] + 1), F.lit("card"))),
            ).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], _plain(text(acc["at"], F.size(tokens)))),
    )


def pieces_of(value: Column) -> Column:
    """A found value as pieces (v, k): itself, or what a run of digits holds."""
    return _with(
        kind_of(value),
        lambda kind: F.when(kind.isNull() & value.rlike(f"^{RUN}$"), _cards(value)).otherwise(F.array(_piece(value, kind))),
    )


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """Replace every validated value in ``text`` by its keyed pseudonym.

    Cards must pass the Luhn test (and still do afterwards), dates lie between 1900-01-01
    and 270 * 271 days later, IPv4 octets between 0 and 255; phone numbers keep their layout
    and country code, social security numbers their layout, e-mail addresses their host and
    punctuation. Case of e-mail names is not kept. Everything else stays byte for byte.
    Returns all columns with ``text`` replaced plus ``n_replaced`` (long) and ``kinds``
    (distinct, sorted, comma-joined; empty if none). Null text stays null with 0. Rows
    repeat as given, equal values always get equal pseudonyms; other columns stay, whatever
    their names, but those named like the two new ones are replaced; an empty table gives no
    rows.
    """
    return shielded(docs, ["text"], ["n_replaced", "kinds"], lambda d: _pseudonymize(d, key))


def _pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    out = docs.withColumn("_ps_found", F.when(F.col("text").rlike("[0-9@]"), F.transform(found, pieces_of)))
    between = F.split("text", PATTERN, -1)
    new = F.transform("_ps_found", lambda ps: F.array_join(F.transform(ps, lambda m: pseudonym(m["v"], m["k"], key)), ""))
    text = F.array_join(
        F.zip_with(between, new, lambda rest, v: F.concat(rest, F.coalesce(v, F.lit("")))), ""
    )
    some = F.coalesce(F.size("_ps_found"), F.lit(0)) > 0
    real = F.filter(F.transform(F.flatten("_ps_found"), lambda m: m["k"]), lambda k: k.isNotNull())
    out = out.withColumn("n_replaced", F.when(some, F.size(real)).otherwise(0).cast("long"))
    out = out.withColumn("kinds", F.when(some, F.array_join(F.array_sort(F.array_distinct(real)), ",")).otherwise(""))
    out = out.withColumn("text", F.when(some, text).otherwise(F.col("text")))
    return out.select(*docs.columns, "n_replaced", "kinds")
