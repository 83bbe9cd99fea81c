"""Surrogates for personal data; DataFrame functions only.

Entities are found by patterns: mail addresses, secrets, account numbers (IBAN), IPv6 and IPv4 addresses,
payment cards, phone numbers (international and national), social security numbers, and names after a form of
address. A name that a text introduces in this way is also found where the same text has it, or a part of it,
without the form of address. Each entity is cut into units (a name has a given and a family name), and a unit
in its canonical spelling gets a surrogate from a keyed digest: character by character within its class, so
script, case, punctuation and length stay, a given name ends by the gender of the form of address, a phone
keeps its country code, a card its issuer digit, an account its country, an IPv6 address its groups of zero.
Check digits of cards and accounts hold in the surrogate where they hold in the text.

The same unit gets the same surrogate everywhere, whatever its spelling, so coreference stays: ``+1 212 555
0147``, ``001 212 555 0147`` and ``(212) 555-0147`` are one unit, as are a short and a full IPv6 spelling. A
national number with a leading zero names no country and is a unit of its own. All distinct
units of the table are then checked: two that would share a surrogate, or one whose surrogate is itself a
unit of the table, are drawn anew, the smallest of a clash aside, until none clash; from the sixth
draw on letters grow longer and zeros of IPv6 addresses are drawn too, so every round can succeed.

Defined results: null and empty texts have no entities and stay (null becomes empty); equal rows get
equal results; an empty table gives none. Nothing is cut: every entity of a text is replaced. Four numbers
with dots after ``version``, ``release`` or ``v`` are no address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import durable

# fixed values: forms of address by gender
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora", "Signora", "г-жа", "κα")
MALE = ("Mr", "Herr", "Monsieur", "Sr", "Señor", "Signor", "г-н", "κος")
# fixed values: vowels and consonants by script
LETTERS = (
    ("aeiou", "a"), ("bcdfghjklmnpqrstvwxyz", ""), ("аеиоу", "а"), ("бвгджзклмнпрстфх", ""), ("αεηιου", "α"),
    ("βγδζθκλμνπρστφχ", ""),
)
_TITLE = "|".join(FEMALE + MALE)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_HEX = "[0-9A-Fa-f]"
#: a word of a name: capital first, also after a hyphen or an apostrophe, so a genitive ends before it
NAME = r"\p{Lu}\p{L}*(?:['’-]\p{Lu}\p{L}*)*"
# kind -> pattern; the first that fits at a place wins
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?=[A-Za-z]*\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])"
    r"|(?<=(?:token|secret|password|api_key|apikey) ?[=:] ?[\"'])[^\s\"']{8,}(?=[\"'])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?:(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?|[0-9A-Z]{11,30})(?![0-9A-Za-z])",
    # all eight groups, or fewer with one gap, and a digit somewhere
    "ipv6": rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*\d)(?:(?:{_HEX}{{1,4}}:){{7}}{_HEX}{{1,4}}"
    rf"|(?=(?:{_HEX}{{1,4}}:){{1,6}}:)(?!{_HEX}*(?::{_HEX}+)*::(?:{_HEX}+:)*:)(?:{_HEX}{{0,4}}:){{2,7}}{_HEX}{{1,4}})"
    r"(?![0-9A-Za-z:])",
    "ip": rf"(?<![\d.vV])(?<![vV]ersion )(?<![rR]elease )(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "card": r"(?<!\d)(?:\d{4}(?:[ -]?\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\d)",
    "phone": r"(?<![\w+])\+(?=(?:[ .()-]*\d){8,15}(?!\d))\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,8}){1,5}(?!\d)"
    r"|(?<![\w+.-])00[1-9]\d{0,2}[ .-](?=(?:[ .()-]*\d){7,13}(?!\d))\(?\d{1,4}\)?(?:[ .-]\d{2,8}){1,4}(?!\d)"
    r"|(?<![\w+)])\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\d)"
    r"|(?<![\w+.-])(?:[2-9]\d{2}-\d{3}-\d{4}|[2-9]\d{2}\.\d{3}\.\d{4})(?![\w-]|\.\d)"
    r"|(?<![\w+.,-])0[1-9](?:(?:[ .-]\d{2}){4}|\d{0,3}(?:[ /-]\d{5,8}| \d{3,4} \d{3,4}))(?![\w-]|[.,]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "person": rf"(?<![\p{{L}}])(?:{_TITLE})\.? {NAME}(?: {NAME})?",
}
ANY = "|".join(PATTERNS.values())
# fixed values: country calling codes of two digits, as a pattern; 1 and 7 have one digit, the others three
CALLING = r"2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
DIGITS = "0123456789"
ALPHANUMERIC = DIGITS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
UNIT = "struct<kind:string,canon:string,form:string>"


#: what every form of address contains, the shorter for the longer
TITLE_ROOTS = sorted({t for t in FEMALE + MALE if not any(o != t and o in t for o in FEMALE + MALE)})
#: text that stays, the entity after it (null: none), and its kind
TOKEN = "struct<before:string,value:string,kind:string>"
GIVEN = ("given-f", "given-m")


def _token(before: Column, value: Column, kind: Column) -> Column:
    return F.struct(before.alias("before"), value.alias("value"), kind.alias("kind"))


def _pieces(text: Column, pattern: str) -> Column:
    """(before, value) in order; the last has no value."""
    return F.arrays_zip(
        F.split(text, pattern, -1).alias("before"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")
    )


def may_hold(text: Column) -> Column:
    """False for text in which no pattern can fit, by cheap searches: every entity has a digit, an at
    sign, a form of address, or stands in quotes after an equals sign or colon."""
    found = text.rlike("[0-9@]") | text.rlike("[=:] ?[\"']")
    for root in TITLE_ROOTS:
        found = found | F.contains(text, F.lit(root))
    return found


def tokens(text: Column) -> Column:
    """A text as entities and what stands before them, in order. No entity reaches past a line, so
    only lines that may hold one meet the patterns."""
    none = F.lit(None).cast("string")

    def read(line: Column, k: Column) -> Column:
        line = F.when(k > 0, F.concat(F.lit("\n"), line)).otherwise(line)
        cut = F.transform(
            _pieces(line, ANY),
            lambda p: _token(p["before"], p["value"], F.when(p["value"].isNotNull(), kind_of(p["value"]))),
        )
        return F.when(may_hold(line), cut).otherwise(F.array(_token(line, none, none)))

    return F.flatten(F.transform(F.split(text, "\n"), read))


def names_of(found: Column) -> Column:
    """(kind, canon) of the names that a text introduces after a form of address."""
    persons = F.filter(found, lambda t: t["kind"] == "person")
    return F.array_distinct(F.transform(
        F.filter(F.flatten(F.transform(persons, lambda t: units(t["value"], t["kind"]))), lambda u: u["kind"] != "title"),
        lambda u: F.struct(u["kind"].alias("kind"), u["canon"].alias("canon")),
    ))


def mentions(found: Column, names: Column) -> Column:
    """Tokens in which the words of ``names`` are entities too: ``family``, ``given-f`` or ``given-m``. A word
    that is both is a family name."""
    own = rf"(?<![\p{{L}}\p{{M}}'’-]){NAME}(?![\p{{L}}\p{{M}}])"

    def as_name(word: Column) -> Column:
        return F.array_min(F.transform(F.filter(names, lambda n: n["canon"] == F.lower(word)), lambda n: n["kind"]))

    def again(t: Column) -> Column:
        return F.transform(
            _pieces(t["before"], own),
            lambda p: F.when(p["value"].isNull(), _token(p["before"], t["value"], t["kind"])).otherwise(
                F.when(as_name(p["value"]).isNull(), _token(F.concat(p["before"], p["value"]), F.lit(None).cast("string"),
                                                            F.lit(None).cast("string")))
                .otherwise(_token(p["before"], p["value"], as_name(p["value"])))),
        )

    return F.when(F.size(names) == 0, found).otherwise(F.flatten(F.transform(found, again)))


def kind_of(entity: Column) -> Column:
    found = F.lit("secret")
    for kind in reversed([k for k in PATTERNS if k != "secret"]):
        found = F.when(entity.rlike(rf"\A(?:{PATTERNS[kind]})\z"), kind).otherwise(found)
    return found


def groups_of(address: Column) -> Column:
    """The eight groups of four hex digits of an IPv6 address in any spelling."""
    left = F.filter(F.split(F.substring_index(address, "::", 1), ":"), lambda g: g != "")
    right = F.when(F.instr(address, "::") > 0, F.filter(F.split(F.substring_index(address, "::", -1), ":"), lambda g: g != "")
                   ).otherwise(F.array().cast("array<string>"))
    gap = F.array_repeat(F.lit("0"), 8 - F.size(left) - F.size(right))
    return F.transform(F.concat(left, gap, right), lambda g: F.lpad(F.lower(g), 4, "0"))


def units(entity: Column, kind: Column) -> Column:
    """(kind, canon, form) parts of an entity; a form of address is a unit that stays."""
    digits = F.regexp_replace(entity, r"\D", "")
    make = lambda k, c, f: F.struct(k.alias("kind"), c.alias("canon"), f.alias("form"))
    title = F.regexp_extract(entity, rf"\A(?:{_TITLE})\.? ", 0)
    names = F.split(F.substr(entity, F.length(title) + 1), " ")
    gender = F.when(F.regexp_replace(title, r"\.? $", "").isin(*FEMALE), "given-f").otherwise("given-m")
    family = F.element_at(names, -1)
    person = F.concat(
        F.array(make(F.lit("title"), title, title)),
        F.when(F.size(names) > 1, F.array(make(gender, F.lower(names[0]), names[0]), make(F.lit("title"), F.lit(" "), F.lit(" ")))
               ).otherwise(F.array().cast(f"array<{UNIT}>")),
        F.array(make(F.lit("family"), F.lower(family), family)),
    )
    # digits from the country code on; ten digits in threes are of the numbering plan of country 1
    phone = (
        F.when(entity.startswith("00"), F.substr(digits, F.lit(3)))
        .when(entity.startswith("+") | entity.startswith("0"), digits)
        .otherwise(F.concat(F.lit("1"), digits))
    )
    return (
        F.when(kind == "person", person)
        .when(kind == "phone", F.array(make(kind, phone, entity)))
        .when(kind.isin("card", "ssn"), F.array(make(kind, digits, entity)))
        .when(kind == "iban", F.array(make(kind, F.replace(entity, F.lit(" "), F.lit("")), entity)))
        .when(kind == "ipv6", F.array(make(kind, F.array_join(groups_of(entity), ":"), entity)))
        .when(kind.isin("email", "family", *GIVEN), F.array(make(kind, F.lower(entity), entity)))
        .otherwise(F.array(make(kind, entity, entity)))
    )


def luhn(digits: Column) -> Column:
    """Sum of a card number's digits, every second from the right doubled; a valid one ends in 0."""
    value = lambda c, k: F.when(k % 2 == 0, c).when(c > 4, 2 * c - 9).otherwise(2 * c)
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, k: value(F.try_to_number(c, F.lit("9")).cast("int"), k))
    return F.aggregate(each, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0)))


def remainder_97(account: Column) -> Column:
    """Remainder by 97 of an account number, country and check digits moved to its end, letters from 10."""
    turned = F.split(F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4))), "")
    value = lambda c: F.instr(F.lit(ALPHANUMERIC), c) - 1
    return F.aggregate(
        F.filter(turned, lambda c: c != ""), F.lit(0),
        lambda rest, c: (rest * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97,
    )


def _draw(digest: Column, k: Column) -> Column:
    """A number of 0 to 255, and on, for place ``k``: two hex digits of the digest, moved on each turn."""
    pair = F.substr(digest, (2 * k) % 62 + 1, F.lit(2))
    return F.conv(pair, 16, 10).cast("int") + F.floor(k / 31).cast("int") * 7


def _other(char: Column, draw: Column, hexadecimal: Column) -> Column:
    pick = lambda alphabet: F.substr(F.lit(alphabet), draw % len(alphabet) + 1, F.lit(1))
    made = F.when(F.instr(F.lit(DIGITS), char) > 0, pick(DIGITS))
    made = made.when(hexadecimal & (F.instr(F.lit("abcdef"), char) > 0), pick("abcdef"))
    made = made.when(hexadecimal & (F.instr(F.lit("ABCDEF"), char) > 0), pick("ABCDEF"))
    for alphabet, _ in LETTERS:
        made = made.when(F.instr(F.lit(alphabet), char) > 0, pick(alphabet))
        made = made.when(F.instr(F.lit(alphabet.upper()), char) > 0, pick(alphabet.upper()))
    return made.otherwise(F.when(char.rlike(r"\p{L}"), pick("aeiou")).otherwise(char))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Keyed surrogate of a canonical unit."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)
    domain = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), F.substring_index(canon, "@", -1)), 256)
    hexadecimal = (kind == "secret") & canon.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z")
    chars = lambda text, seed, hexa: F.array_join(
        F.transform(F.split(text, ""), lambda c, k: _other(c, _draw(seed, k), hexa)), ""
    )
    no = F.lit(False)
    octets = F.array_join(
        F.transform(F.array(*map(F.lit, range(4))),
                    lambda k: F.when(k == 0, _draw(digest, k) % 223 + 1).otherwise(_draw(digest, k)).cast("string")), "."
    )
    user, host = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    labels = F.regexp_replace(host, r"\.[^.]*\z", "")
    plain = chars(canon, digest, hexadecimal)
    more = F.substr(chars(F.lit("anoreli"), F.reverse(digest), no), F.lit(1), F.greatest(attempt - 4, F.lit(0)))
    ending = F.when(kind == "given-f", "a").otherwise("n")
    for alphabet, vowel in LETTERS:
        if vowel and vowel != "a":
            here = canon.rlike(f"[{alphabet}]")
            ending = F.when(here & (kind == "given-f"), vowel).when(here, "ν" if vowel == "α" else "н").otherwise(ending)
    card = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(plain, F.lit(2)))
    front = F.substr(card, F.lit(1), F.length(card) - 1)
    check = (10 - luhn(F.concat(front, F.lit("0"))) % 10) % 10
    country = F.substr(canon, F.lit(1), F.lit(2))
    account = F.array_join(F.transform(  # capitals of any letter, unlike names
        F.split(F.substr(canon, F.lit(5)), ""), lambda c, k: F.when(
            F.instr(F.lit(DIGITS), c) > 0, F.substr(F.lit(DIGITS), _draw(digest, k) % 10 + 1, F.lit(1))
        ).otherwise(F.when(c != "", F.substr(F.lit(ALPHANUMERIC), _draw(digest, k) % 26 + 11, F.lit(1))).otherwise(""))), "")
    two = F.lpad((98 - remainder_97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    stays = (
        F.when(canon.startswith("0"), 2).when(canon.rlike(r"\A[17]"), 1).when(canon.rlike(rf"\A(?:{CALLING})"), 2).otherwise(3)
    )
    # leading zeros of a group stay, its first digit is no zero
    group = lambda g, at: F.array_join(F.transform(F.split(g, ""), lambda c, k: F.when(
        (attempt <= 5) & F.substr(g, F.lit(1), k + 1).rlike(r"\A0+\z"), F.lit("0")
    ).when((attempt <= 5) & F.substr(g, F.lit(1), k).rlike(r"\A0*\z"), F.substr(F.lit("123456789abcdef"), _draw(digest, at + k) % 15 + 1, F.lit(1))
           ).otherwise(F.substr(F.lit("0123456789abcdef"), _draw(digest, at + k) % 16 + 1, F.lit(1)))), "")
    address = F.array_join(F.transform(F.split(canon, ":"), lambda g, k: group(g, 4 * k)), ":")
    return (
        F.when(kind == "ip", octets)
        .when(kind == "email", F.concat(chars(user, digest, no), more, F.lit("@"), chars(labels, domain, no),
                                        F.substr(host, F.length(labels) + 1)))
        .when(kind == "ipv6", address)
        .when(kind == "card", F.when(luhn(canon) % 10 == 0, F.concat(front, check.cast("string"))).otherwise(card))
        .when(kind == "iban", F.concat(
            country, F.when(remainder_97(canon) == 1, two).otherwise(F.substr(plain, F.lit(3), F.lit(2))), account))
        .when(kind == "phone", F.concat(F.substr(canon, F.lit(1), stays), F.substr(plain, stays + 1)))
        .when(kind.isin("given-f", "given-m"), F.concat(
            F.substr(plain, F.lit(1), F.length(plain) - 1), more, ending))
        .when(kind == "ssn", plain)
        .otherwise(F.concat(plain, more))
    )


def shaped(kind: Column, form: Column, made: Column) -> Column:
    """A surrogate in the spelling of one occurrence: separators of numbers, groups of addresses, capitals of
    words. A number without its country code takes the last digits."""
    shown = F.length(F.regexp_replace(form, "[^0-9A-Z]", ""))
    filling = F.when((kind == "phone") & form.startswith("00"), F.concat(F.lit("00"), made)).otherwise(made)
    skipped = F.length(filling) - shown
    number = F.aggregate(
        F.split(form, ""),
        F.struct(skipped.alias("k"), F.lit("").alias("out")),
        lambda acc, c: F.when(
            c.rlike("[0-9A-Z]"),
            F.struct((acc["k"] + 1).alias("k"), F.concat(acc["out"], F.substr(filling, acc["k"] + 1, F.lit(1))).alias("out")),
        ).otherwise(F.struct(acc["k"].alias("k"), F.concat(acc["out"], c).alias("out"))),
        lambda acc: acc["out"],
    )
    made_groups = F.split(made, ":")

    def written(part: Column, first: Column) -> Column:
        """Groups of the address as long as they are in the text, from place ``first`` on."""
        shorts = F.filter(F.split(part, ":"), lambda g: g != "")
        return F.array_join(F.transform(shorts, lambda g, k: F.right(F.get(made_groups, first + k), F.length(g))), ":")

    tail = F.substring_index(form, "::", -1)
    tail_size = F.size(F.filter(F.split(tail, ":"), lambda g: g != ""))
    address = F.when(
        F.array_join(F.filter(F.transform(made_groups, lambda g, k: F.when(g == "0000", k.cast("string"))), lambda k: k.isNotNull()), ",")
        != F.array_join(F.filter(F.transform(groups_of(form), lambda g, k: F.when(g == "0000", k.cast("string"))), lambda k: k.isNotNull()), ","),
        made,
    ).when(F.instr(form, "::") > 0, F.concat(written(F.substring_index(form, "::", 1), F.lit(0)), F.lit("::"), written(tail, 8 - tail_size))
           ).otherwise(written(form, F.lit(0)))
    address = F.when(form.rlike("[A-F]"), F.upper(address)).otherwise(address)
    capital = F.concat(F.upper(F.substr(made, F.lit(1), F.lit(1))), F.substr(made, F.lit(2)))
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), number)
        .when(kind == "ipv6", address)
        .when(kind.isin("ip", "secret"), made)
        .when((form == F.upper(form)) & (F.length(form) > 1), F.upper(made))
        .when(F.substr(form, F.lit(1), F.lit(1)) != F.lower(F.substr(form, F.lit(1), F.lit(1))), capital)
        .otherwise(made)
    )


def assign(found: DataFrame, key: str) -> DataFrame:
    """(kind, canon, made): distinct surrogates for the distinct units of ``found``.

    Kinds with the same space are told apart only as far as their spellings can meet: all are
    checked together.
    """
    settled = None
    open_ = durable(found.distinct().withColumn("attempt", F.lit(0)))
    everything = open_.select(F.col("canon").alias("made")).distinct()
    while True:
        made = open_.withColumn("made", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
        made = made.withColumn("who", F.concat_ws("\x1f", "kind", "canon"))
        first = made.groupBy("made").agg(F.min("who").alias("winner"))
        held = [everything.withColumn("taken", F.lit(True))]
        if settled is not None:
            held.append(settled.select("made", F.lit(True).alias("taken")))
        taken = held[0] if len(held) == 1 else held[0].unionByName(held[1]).distinct()
        judged = durable(
            made.join(first, "made").join(taken, "made", "left")
            .withColumn("good", (F.col("who") == F.col("winner")) & F.col("taken").isNull())
        )
        done = judged.where("good").select("kind", "canon", "made")
        settled = durable(done if settled is None else settled.unionByName(done))
        open_ = durable(judged.where(~F.col("good")).select("kind", "canon", (F.col("attempt") + 1).alias("attempt")))
        if not open_.take(1):
            return settled


def replace_entities(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_entities, kinds, surrogates, text), one row for each row of ``docs``: kinds and surrogates
    of the entities in order, and the text with them in place. ``key`` is the secret of the surrogates.

    Only rows with entities are shuffled, by a row number that is written down first.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn(
        "tokens", F.when(may_hold(F.col("text")), tokens(F.col("text"))).otherwise(F.array().cast(f"array<{TOKEN}>"))
    )
    found = F.exists("tokens", lambda t: t["value"].isNotNull())
    none = F.array().cast("array<string>")
    clean = cut.where(~found).select(
        "doc_id", F.lit(0).cast("long").alias("n_entities"), none.alias("kinds"), none.alias("surrogates"), "text"
    )
    placed = F.transform("tokens", lambda t, k: F.struct(k.alias("place"), t["value"].alias("value"), t["kind"].alias("kind")))
    rows = durable(
        cut.where(found)
        .select("doc_id", "tokens", names_of(F.col("tokens")).alias("names"))
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", mentions(F.col("tokens"), F.col("names")).alias("tokens"))
        .withColumn("entities", F.filter(placed, lambda t: t["value"].isNotNull()))
    )
    parts = rows.select("row", F.inline("entities")).select(
        "row", "place", F.posexplode(units(F.col("value"), F.col("kind"))).alias("part", "unit")
    ).select("row", "place", "part", "unit.*")
    drawn = assign(parts.where(F.col("kind") != "title").select("kind", "canon"), key)
    written = parts.join(drawn, ["kind", "canon"], "left").select(
        "row", "place",
        F.struct(
            "part",
            F.when(F.col("kind") == "title", F.col("form")).otherwise(
                shaped(F.col("kind"), F.col("form"), F.col("made"))).alias("made"),
        ).alias("piece"),
    )
    whole = written.groupBy("row", "place").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["made"]), "").alias("made")
    )
    by_row = whole.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "made"))).alias("made"))
    # a token without an entity is followed by nothing; by place, so no token is searched for
    gaps = F.filter(
        F.transform("tokens", lambda t, k: F.struct(k.alias("place"), F.when(t["value"].isNull(), "").alias("made"))),
        lambda g: g["made"].isNotNull(),
    )
    after = F.array_sort(F.concat("made", gaps))
    return rows.join(by_row, "row").select(
        "doc_id",
        F.size("entities").cast("long").alias("n_entities"),
        F.transform("entities", lambda e: e["kind"]).alias("kinds"),
        F.transform("made", lambda m: m["made"]).alias("surrogates"),
        F.array_join(F.zip_with("tokens", after, lambda t, m: F.concat(t["before"], m["made"])), "").alias("text"),
    ).unionByName(clean)
