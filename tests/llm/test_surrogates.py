import ipaddress
import random
import re

from marketlake.llm.surrogates import ANY, assign, replace_entities

ROWS = [
    (1, "Write to Ann.Lee7@mail.example.com or ann.lee7@MAIL.example.com now."),
    (2, "Call +1 (017) 555-7713 or +1 017 555 7713, card 9807915762804490 or 9807-9157-6280-4490."),
    (3, 'token = "abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71" from 97.51.17.173.'),
    (4, "Mr. John Smith met Mrs. Smith and Frau Anna Müller; г-жа Анна Петрова called. Mr John Smith left."),
    (5, "Version 2.0, 4.0. and 1.2.3.4.5 and 12345 stay."), (6, None), (7, ""), (8, "97.51.17.173"), (8, "97.51.17.173"),
]


def test_surrogates_keep_type_format_gender_and_reference(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as kinds", "2 as row")
    got = {r.doc_id: r for r in replace_entities(docs, "k").collect()}
    assert sum(1 for _ in replace_entities(docs, "k").collect()) == len(ROWS)
    mail = got[1].surrogates
    assert got[1].kinds == ["email", "email"] and mail[0].lower() == mail[1].lower() and mail[0].endswith(".com")
    assert "ann.lee" not in got[1].text.lower() and re.fullmatch(r"[\w.]{8}@\w{4}\.\w{7}\.com", mail[0])
    phone, other, card, dashed = got[2].surrogates
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phone) and re.fullmatch(r"\+1 \d{3} \d{3} \d{4}", other)
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(phone) == digits(other) != "10175557713"
    assert digits(card) == digits(dashed) and card[0] == "9" and len(card) == 16
    secret, ip = got[3].surrogates
    assert re.fullmatch(r"[0-9a-f]{40}", secret) and all(0 <= int(x) < 256 for x in ip.split("."))
    assert got[8].text == ip
    first, wife, frau, russian, again = got[4].surrogates
    assert first.split(" ")[1:] == again.split(" ")[1:] and first.split()[-1] == wife.split()[-1]
    assert frau.split()[1].endswith("a") and first.split()[1].endswith("n")
    assert re.fullmatch(r"г-жа [А-Я][а-я]+а [А-Я][а-я]+", russian)
    assert got[5].text == ROWS[4][1] and got[5].n_entities == 0
    assert got[6].text == got[7].text == ""
    for r in got.values():  # nothing of the entities stays
        for entity in re.findall(r"[\w.]+@[\w.]+|\+1[\d ()-]+|\d{16}|\d+\.\d+\.\d+\.\d+", dict(ROWS)[r.doc_id] or ""):
            assert r.doc_id == 5 or entity not in r.text


def test_clashes_are_drawn_anew(spark):
    # two-letter names have 105 shapes of this kind: 90 of them must clash
    names = [c + v for c in "bcdfghjklmnpqrstvwxyz" for v in "aeiou"][:90]
    units = spark.createDataFrame([("family", n) for n in names], "kind string, canon string")
    got = assign(units, "k").collect()
    made = [r.made for r in got]
    assert sorted(r.canon for r in got) == sorted(names)
    assert len(set(made)) == len(made) and not set(made) & set(names)
    assert {(r.canon, r.made) for r in assign(units, "k").collect()} == {(r.canon, r.made) for r in got}


def test_odd_rows(spark, odd, none):
    got = replace_entities(odd, "k")
    assert got.count() == odd.count()
    assert sorted(r.text for r in got.collect()) == sorted(r.text or "" for r in odd.collect())
    assert replace_entities(none, "k").count() == 0


def _card(rnd, front, size):
    digits = front + "".join(rnd.choice("0123456789") for _ in range(size - len(front) - 1))
    return next(digits + c for c in "0123456789" if luhn_sum(digits + c) % 10 == 0)


def luhn_sum(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled)


def iban_rest(account):
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def _iban(rnd):
    country, account = rnd.choice(("DE", "FR", "GB")), "".join(rnd.choice("0123456789") for _ in range(18))
    account = rnd.choice(("", "WEST")) + account
    return next(country + f"{k:02}" + account for k in range(2, 99) if iban_rest(country + f"{k:02}" + account) == 1)


def _fours(text):
    return " ".join(text[k:k + 4] for k in range(0, len(text), 4))


def planted_entities(rnd):
    """(kind, canonical, spelling) of random entities, the spelling one of several of the same thing."""
    n = lambda k: "".join(rnd.choice("23456789") for _ in range(k))
    area, mid, last = n(3), n(3), n(4)
    yield "phone", "1" + area + mid + last, rnd.choice(
        (f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"+1 {area} {mid} {last}", f"001 {area} {mid} {last}", f"+1{area}{mid}{last}"))
    local = n(7)
    yield "phone", "4930" + local, rnd.choice((f"0049 30 {local}", f"+49 30 {local}", f"+4930{local}"))
    yield "phone", "030" + local, rnd.choice((f"030 {local}", f"030/{local}"))
    two = [n(2) for _ in range(4)]
    yield "phone", "331" + "".join(two), "+33 1 " + " ".join(two)
    yield "phone", "01" + "".join(two), "01 " + " ".join(two)
    amex, visa = _card(rnd, "37", 15), _card(rnd, "4", 16)
    yield "card", amex, rnd.choice((amex, f"{amex[:4]} {amex[4:10]} {amex[10:]}"))
    yield "card", visa, rnd.choice((visa, _fours(visa)))
    account = _iban(rnd)
    yield "iban", account, rnd.choice((account, _fours(account)))
    address = ipaddress.ip_address(f"2001:db8::{rnd.randrange(1, 65536):x}:{rnd.randrange(1, 65536):x}")
    yield "ipv6", address.exploded, rnd.choice((str(address), address.exploded, str(address).upper()))
    yield "ip", "", ".".join(str(rnd.randrange(1, 255)) for _ in range(4))


def test_planted_entities_are_found_and_their_surrogates_are_one_to_one(spark):
    rnd = random.Random(7)
    pool = [e for _ in range(30) for e in planted_entities(rnd)]
    again = [e for seed in range(30) for e in planted_entities(random.Random(seed % 6))]  # the same things, other spellings
    docs, truth = [], {}
    for doc in range(300):
        here = [rnd.choice(pool + again) for _ in range(rnd.randrange(1, 6))]
        filler = [" ".join(rnd.choice(("alpha", "beta", "in 1999", "no. 12", "a:b", "x::y", "3.14", "v1.2.3.4", "version 10.2.3.4", "\n"))
                           for _ in range(rnd.randrange(1, 9))) for _ in range(len(here) + 1)]
        docs.append((doc, " , ".join(x for pair in zip(filler, [e[2] for e in here] + [""]) for x in pair)))
        truth[doc] = here, filler
    got = {r.doc_id: r for r in replace_entities(spark.createDataFrame(docs, "doc_id long, text string"), "k").collect()}
    assert len(got) == len(docs)
    made, back = {}, {}
    plain = lambda s: re.sub(r"\W", "", s)
    for doc, (here, filler) in truth.items():
        r = got[doc]
        assert r.kinds == [kind for kind, _, _ in here], (docs[doc], r)
        assert r.text == " , ".join(x for pair in zip(filler, [*r.surrogates, ""]) for x in pair)
        for (kind, canon, spelling), other in zip(here, r.surrogates):
            canon = canon or spelling
            assert other != spelling and (kind == "ip" or re.sub("[0-9A-Za-z]", "x", other) == re.sub("[0-9A-Za-z]", "x", spelling))
            digits = plain(other)
            if kind == "phone":
                digits = digits[2:] if other.startswith("00") else digits if other[0] in "+0" else "1" + digits
                assert digits.startswith("1" if canon[0] == "1" else canon[:2])
            elif kind == "card":
                assert luhn_sum(digits) % 10 == 0 and digits[0] == canon[0]
            elif kind == "iban":
                assert iban_rest(digits) == 1 and digits[:2] == canon[:2]
            elif kind == "ipv6":
                digits = ipaddress.ip_address(other).exploded
            assert made.setdefault((kind, canon), digits) == digits
            assert back.setdefault((kind, digits), canon) == canon
    assert not set(made.values()) & {canon for _, canon in made}


def test_names_without_their_form_of_address(spark):
    docs = spark.createDataFrame([
        (1, "Smith waits. Mr. John Smith's car. Later John Smith and SMITH met; Smithson and john stay, Smith-Jones too."),
        (2, "John Smith, who is not introduced, stays."),
        (3, "Frau Anna Müller-Lang kam.\nAnna ging, Müller-Lang blieb."),
        (4, "Herr John Smith"),
    ], "doc_id long, text string")
    got = {r.doc_id: r for r in replace_entities(docs, "k").collect()}
    first = got[1]
    assert first.kinds == ["family", "person", "given-m", "family", "family"]
    family, (_, given, same), later, plain, loud = (first.surrogates[0], first.surrogates[1].split(" "), *first.surrogates[2:])
    assert family == same == plain == loud.capitalize() and loud.isupper() and later == given
    assert first.text == (f"{family} waits. Mr. {given} {family}'s car. Later {given} {family} and {loud} met; "
                          "Smithson and john stay, Smith-Jones too.")
    assert got[2].n_entities == 0 and got[2].text.startswith("John Smith")
    assert got[3].kinds == ["person", "given-f", "family"]
    assert got[3].surrogates[0].split(" ")[1:] == list(got[3].surrogates[1:])
    assert got[4].text == f"Herr {given} {family}"
