"""Format-preserving Feistel pseudonyms for personal data, in DataFrame functions only.

One pattern finds candidates; a text is split at them and put together again
with each candidate's pseudonym, if it is valid (Luhn and mod-97 check digits,
octets up to 255, calendar dates; phone and social security numbers, e-mail
addresses and keys by form). A pseudonym is a keyed permutation within the format: a Feistel network
whose halves add a keyed hash of each other. Equal values get equal pseudonyms in all documents,
different ones different; the key holder can turn them back. Check digits are made valid again.
Cards and IBANs beside other numbers are found at group borders; there a value's pseudonym can be another one
than alone, where the neighbours would be read with it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_EPOCH, _DAYS = "1900-01-01", 1 << 16  # dates that are permuted: 1900-01-01 to 2079-06-05

# The forms, in the order they are tried at a place.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z])(?i:password|passwd|secret|token|api_key|apikey)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_\-]{8,}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
    "date": r"(?<![0-9.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,36}(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
}
IBAN_LENGTHS = {country: int(n) for n, countries in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,DZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:AO,CV,LY,MZ,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for country in countries.split(",")}
TURNS = 64  # pseudonyms of pseudonyms that are tried where the characters around would be read with them
_ANY = "|".join(FORMS.values())
_FENCE = "\u0001\u0002"
_SEPARATORS = "[^A-Za-z0-9]"


def _hex(key: str, kind: str, turn: Column, other: Column) -> Column:
    """128 hex digits of a keyed hash."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other.cast("string")), 512)


def _number(hexes: Column, at: Column | int, digits: int) -> Column:
    return F.conv(F.substr(hexes, F.lit(at) if isinstance(at, int) else at, F.lit(digits)), 16, 10).cast("int")


def _network(start: Column, turn: Callable[[Column, Column], Column], restore: bool) -> Column:
    rounds = [F.lit(i) for i in (reversed(range(ROUNDS)) if restore else range(ROUNDS))]
    return F.aggregate(F.array(*rounds), start, turn)


def permute_text(text: Column, key: str, kind: str, restore: bool = False) -> Column:
    """Permute digits among digits, lower and upper case letters among theirs; other characters stay."""
    sign = -1 if restore else 1

    def added(half: Column, hexes: Column) -> Column:
        def one(letter: Column, i: Column) -> Column:
            code, shift = F.ascii(letter), sign * _number(hexes, (i % 64) * 2 + 1, 2)
            cases = [(code.between(first, first + size - 1), F.char(F.pmod(code - first + shift, F.lit(size)) + first)) for first, size in ((48, 10), (97, 26), (65, 26))]
            return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), cases, letter)
        return F.array_join(F.transform(F.split(half, ""), one), "")

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, added(s.l, _hex(key, kind, i, s.r))).otherwise(s.l).alias("l"),
                        F.when(even, s.r).otherwise(added(s.r, _hex(key, kind, i, s.l))).alias("r"))

    half = (F.length(text) / 2).cast("int")
    done = _network(F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r")), turn, restore)
    return F.concat(done.l, done.r)


def permute_number(number: Column, half_size: int, key: str, kind: str, restore: bool = False) -> Column:
    """Permute the integers below half_size ** 2."""
    sign = -1 if restore else 1

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, F.pmod(s.l + sign * _number(_hex(key, kind, i, s.r), 1, 7), F.lit(half_size))).otherwise(s.l).alias("l"),
                        F.when(even, s.r).otherwise(F.pmod(s.r + sign * _number(_hex(key, kind, i, s.l), 1, 7), F.lit(half_size))).alias("r"))

    done = _network(F.struct(F.floor(number / half_size).cast("int").alias("l"), (number % half_size).cast("int").alias("r")), turn, restore)
    return done.l.cast("bigint") * half_size + done.r


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, _SEPARATORS, "")


def _dressed(bare: Column, like: Column) -> Column:
    """Put `bare` into the places of letters and digits of `like`."""
    def one(letter: Column, i: Column) -> Column:
        at = F.length(_bare(F.substr(like, F.lit(1), i + 1)))
        return F.when(F.rlike(letter, F.lit(_SEPARATORS)), letter).otherwise(F.substr(bare, at, F.lit(1)))
    return F.array_join(F.transform(F.split(like, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    """Sum of digits, every second from the right doubled (and its digits added)."""
    def one(digit: Column, i: Column) -> Column:
        twice = digit.cast("int") * (1 + i % 2)
        return F.floor(twice / 10).cast("int") + twice % 10
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda s, x: s + x)


def mod_97(text: Column) -> Column:
    """The text as a number (A is 10 ... Z is 35), modulo 97."""
    def more(s: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (s * 10 + code - 48) % 97).otherwise((s * 100 + code - 55) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), more)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _is_card(m: Column) -> Column:
    return _let(_bare(m), lambda digits: F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0))


def _is_iban(m: Column) -> Column:
    return _let(_bare(m), lambda bare: mod_97(F.concat(F.substr(bare, F.lit(5), F.length(bare)), F.substr(bare, F.lit(1), F.lit(4)))) == 1)


def _borders(m: Column) -> Column:
    """Places behind the groups of `m`."""
    return F.filter(F.sequence(F.lit(1), F.length(m)), lambda e: (e == F.length(m)) | F.rlike(F.substr(m, e + 1, F.lit(1)), F.lit(_SEPARATORS)))


def _cards(m: Column) -> Column:
    """(at, size) of the cards in a run of digits: from left to right, at each group the longest that is valid."""
    def from_group(s: Column, ends: Column, at: Column) -> Column:
        size = F.array_max(F.filter(F.transform(ends, lambda e: e - at + 1), lambda n: n.between(13, 37) & _is_card(F.substr(m, at, n))))
        return F.when(at < s.next, s).otherwise(_let(size, lambda n: F.when(n.isNull(), s).otherwise(
            F.struct((at + n).alias("next"), F.concat(s.found, F.array(F.struct(at.alias("at"), n.alias("size")))).alias("found")))))

    def cards(ends: Column) -> Column:
        starts = F.concat(F.array(F.lit(1)), F.transform(F.filter(ends, lambda e: e < F.length(m)), lambda e: e + 2))
        first = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<at:int,size:int>>").alias("found"))
        return F.aggregate(starts, first, lambda s, at: from_group(s, ends, at), lambda s: s.found)

    return F.when(_is_card(m), F.array(F.struct(F.lit(1).alias("at"), F.length(m).alias("size")))).otherwise(_let(_borders(m), cards))


def _ibans(m: Column) -> Column:
    """(at, size) of the IBAN in a candidate: the country's length if it is valid, else the whole."""
    length = F.element_at(F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair]), F.substr(m, F.lit(1), F.lit(2)))
    sizes = F.filter(F.concat(F.filter(_borders(m), lambda e: F.length(_bare(F.substr(m, F.lit(1), e))) == length), F.array(F.length(m))), lambda e: _is_iban(F.substr(m, F.lit(1), e)))
    return F.transform(F.slice(sizes, 1, 1), lambda n: F.struct(F.lit(1).alias("at"), n.alias("size")))


def _inside(parts: Callable[[Column], Column], made: Callable[[Column, str, bool], Column]) -> Callable[[Column, str, bool], Column]:
    """Pseudonyms of the valid parts of a candidate. Where a pseudonym and the characters around it would be
    read as other parts, its own pseudonym is taken, and so on: so that it can be turned back."""
    def one(m: Column, part: Column, all_parts: Column, key: str, restore: bool) -> Column:
        def turn(s: Column) -> Column:
            text = F.concat(F.substr(s.text, F.lit(1), part.at - 1), made(F.substr(s.text, part.at, part.size), key, restore), F.substr(s.text, part.at + part.size, F.length(s.text)))
            return _let(text, lambda t: F.struct(t.alias("text"), (parts(t) == all_parts).alias("done")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), F.struct(m.alias("text"), F.lit(False).alias("done")),
                           lambda s, _: F.when(s.done, s).otherwise(turn(s)), lambda s: F.when(s.done, s.text).otherwise(m))

    def whole(m: Column, key: str, restore: bool) -> Column:
        return _let(parts(m), lambda found: F.aggregate(F.reverse(found) if restore else found, m, lambda text, part: one(text, part, found, key, restore)))
    return whole


def _card(m: Column, key: str, restore: bool) -> Column:
    digits = _bare(m)
    body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), permute_text(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card", restore))
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return _dressed(F.concat(body, check), m)


def _iban(m: Column, key: str, restore: bool) -> Column:
    bare = _bare(m)
    country, account = F.substr(bare, F.lit(1), F.lit(2)), F.substr(bare, F.lit(5), F.length(bare))
    made = permute_text(account, key, "iban", restore)
    check = F.lpad((98 - mod_97(F.concat(made, country, F.lit("00")))).cast("string"), 2, "0")
    return _dressed(F.concat(country, check, made), m)


def _phone(m: Column, key: str, restore: bool) -> Column:
    digits = _bare(m)
    return _dressed(F.concat(F.substr(digits, F.lit(1), F.lit(2)), permute_text(F.substr(digits, F.lit(3), F.length(digits)), key, "phone", restore)), m)


def _ip(m: Column, key: str, restore: bool) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("bigint"))
    made = permute_number(F.aggregate(octets, F.lit(0).cast("bigint"), lambda s, o: s * 256 + o), 1 << 16, key, "ip", restore)
    back = F.concat_ws(".", *[F.pmod(F.shiftright(made, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])
    return F.when(F.forall(octets, lambda o: o < 256), back).otherwise(m)


def _date(m: Column, key: str, restore: bool) -> Column:
    iso = F.rlike(m, F.lit("^[0-9]{4}-"))
    year = F.when(iso, F.substr(m, F.lit(1), F.lit(4))).otherwise(F.substr(m, F.lit(7), F.lit(4)))
    day = F.when(iso, F.substr(m, F.lit(9), F.lit(2))).otherwise(F.substr(m, F.lit(1), F.lit(2)))
    month = F.when(iso, F.substr(m, F.lit(6), F.lit(2))).otherwise(F.substr(m, F.lit(4), F.lit(2)))
    epoch = F.lit(_EPOCH).cast("date")
    number = F.datediff(F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd"), epoch)
    made = F.date_add(epoch, permute_number(number, 1 << 8, key, "date", restore).cast("int"))
    separator = F.substr(m, F.lit(3), F.lit(1))
    shown = F.when(iso, F.date_format(made, "yyyy-MM-dd")).otherwise(F.concat_ws("", F.date_format(made, "dd"), separator, F.date_format(made, "MM"), separator, F.date_format(made, "yyyy")))
    return F.when(number.between(0, _DAYS - 1), shown).otherwise(m)


def _ssn(m: Column, key: str, restore: bool) -> Column:
    return _dressed(permute_text(_bare(m), key, "ssn", restore), m)


def _after(prefix: str, kind: str) -> Callable[[Column, str, bool], Column]:
    def made(m: Column, key: str, restore: bool) -> Column:
        start = F.regexp_extract(m, prefix, 0)
        return F.concat(start, permute_text(F.substr(m, F.length(start) + 1, F.length(m)), key, kind, restore))
    return made


def _email(m: Column, key: str, restore: bool) -> Column:
    at = F.instr(m, "@")
    return F.concat(permute_text(F.substr(m, F.lit(1), at - 1), key, "email", restore), F.substr(m, at, F.length(m)))


_PSEUDONYMS = {"email": _email, "key": _after("^AKIA", "key"), "secret": _after("^[A-Za-z_]+\\s*[=:]\\s*[\"']?", "secret"), "iban": _inside(_ibans, _iban), "phone": _phone,
               "date": _date, "ssn": _ssn, "card": _inside(_cards, _card), "ip": _ip}
# What a candidate is, told from the candidate alone.
_TOLD = {"email": "@", "key": "^AKIA[0-9A-Z]{16}$", "secret": "[=:]", "iban": "^[A-Z]{2}[0-9]{2}", "phone": r"^[+(]",
         "date": r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})$", "ssn": "^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "ip": r"\.", "card": "^[0-9]"}


def pseudonym(m: Column, key: str, restore: bool = False) -> Column:
    """The pseudonym of a candidate; the candidate itself if it is not valid."""
    return reduce(lambda rest, kind: F.when(F.rlike(m, F.lit(_TOLD[kind])), _PSEUDONYMS[kind](m, key, restore)).otherwise(rest), reversed(_TOLD), m)


def _values_changed(m: Column, made: Column) -> Column:
    several = F.rlike(m, F.lit("^[0-9](?:[ -]?[0-9]){25,}$"))  # digits of two cards
    return F.when(m == made, 0).when(several, F.size(F.filter(_cards(m), lambda x: F.substr(m, x.at, x.size) != F.substr(made, x.at, x.size)))).otherwise(1)


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text", restore: bool = False) -> DataFrame:
    """`docs` with `text_col` pseudonymised and columns added: __n_pseudonyms (values that changed).

    Formats stay as they were, and lengths but for IP addresses. Dates outside 1900-01-01 to 2079-06-05 and
    candidates with wrong check digits stay. Null texts stay null, empty ones empty; rows are
    independent, other columns are untouched. `restore` turns pseudonyms made with the same key back.
    """
    text = F.col(text_col)
    # Candidates are fenced and the text split at the fences, in one linear pass; a text that holds
    # the fence itself is left as one part, and its candidates are extracted one by one.
    likely, fenced = F.rlike(text, F.lit("[0-9@]|AKIA|(?i:passw|secret|token|api)")), F.contains(text, F.lit(_FENCE))
    parts = F.split(F.regexp_replace(text, f"(?:{_ANY})", f"{_FENCE}$0{_FENCE}"), _FENCE)
    df = docs.withColumn("__parts", F.when(likely & ~fenced, parts).when(likely, F.flatten(F.zip_with(
        F.split(text, _ANY, -1), F.concat(F.regexp_extract_all(text, F.lit(f"(?:{_ANY})"), F.lit(0)), F.array(F.lit(""))), lambda a, b: F.array(a, b)))))
    df = df.withColumn("__found", F.filter("__parts", lambda x, i: i % 2 == 1))
    df = df.withColumn("__made", F.transform("__found", lambda m: pseudonym(m, key, restore)))
    whole = F.array_join(F.transform("__parts", lambda x, i: F.when(i % 2 == 1, F.get("__made", F.floor(i / 2).cast("int"))).otherwise(x)), "")
    changed = F.aggregate(F.zip_with("__found", "__made", _values_changed), F.lit(0), lambda n, x: n + x)
    return (df.withColumn("__n_pseudonyms", F.when(F.size("__found") > 0, changed).otherwise(F.lit(0)).cast("bigint"))
            .withColumn(text_col, F.when(F.size("__found") > 0, whole).otherwise(text)).drop("__parts", "__found", "__made"))
