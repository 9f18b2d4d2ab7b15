"""Surrogates for personal data, by DataFrame expressions only.

Entities (mail and network addresses, phone, card and social security numbers,
bank accounts, hexadecimal and other secrets, names behind a form of address) are found by one pattern.
An entity is known by its kind and canonical form (digits without grouping,
letters in lower case), so spellings of one entity share a surrogate all over the
corpus. A surrogate comes from a keyed hash and keeps kind and format: lengths,
grouping and case, country code, top-level domain, ranges of address parts, a
valid card checksum if the original had one, and for names the gender of the
form of address and the script of the letters.

Surrogates are then checked: two entities must not get the same one, and none
may be an entity of the corpus, of whatever kind. Who loses such a collision gets the next value
of its hash, until all are apart. Where few values are left, numbers get more digits
from round to round, names more syllables, so that a form is never used up.

Only texts with an entity are shuffled; they meet their surrogates by the hash
of the text, since positions depend on nothing else.

Defined cases: null text stays null with no entities; rows with null or repeated
ids are treated like any other; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored

KEY = "set a secret of your own"
ROUNDS = 12  # collision rounds before any surrogate may grow longer than its original; a name gets a syllable more each round
GROW = 4  # rounds after which numbers get a digit more each round
TASK_ROWS = 2_000  # surrogates made in a task

_EDGE, _NO_MORE = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_WOMEN, _MEN = r"(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа)", r"(?:Mr|Herr|Monsieur|Señor|Sr|Господин)"
_HEX = r"[0-9A-Fa-f]{1,4}"
_SOME_HEX = f"(?:{_HEX}(?::{_HEX}){{0,6}})?"
_CALLING = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"  # country code
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "iban": _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _NO_MORE,
    "ip": _EDGE + r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\p{L}\p{N}]|\.\d)",
    "ipv6": r"(?<![\p{L}\p{N}:])(?=[0-9A-Fa-f:]{0,39}[0-9])(?:(?:" + _HEX + r":){7}" + _HEX + f"|{_SOME_HEX}::{_SOME_HEX})" + r"(?![\p{L}\p{N}:])",
    "phone": r"(?<![\p{L}\p{N}+])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}" + _NO_MORE
    + r"|\+\d(?:(?:[ .()/-](?!\d{3}-\d{2}-\d{4}|\d{4}[ -]\d{4}[ -]\d{4})){0,2}\d){6,14}" + _NO_MORE
    + r"|(?<![.-])\d{3}-\d{4}(?![\p{L}\p{N}]|[.-]\d))",
    "ssn": _EDGE + r"\d{3}-\d{2}-\d{4}" + _NO_MORE,
    "card": _EDGE + r"(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})" + _NO_MORE,
    "secret": _EDGE + r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _NO_MORE,
    "token": r"(?<![\p{L}\p{N}+/_-])(?:AKIA[0-9A-Z]{16}|[spr]k[-_][A-Za-z0-9_-]{16,128}|gh[pousr]_[A-Za-z0-9]{36,128}|xox[abprs]-[A-Za-z0-9-]{10,128}"
    + r"|(?=[^a-z]{0,127}[a-z])(?=[^A-Z]{0,127}[A-Z])(?=[^0-9]{0,127}[0-9])[A-Za-z0-9+/_-]{32,128}={0,2})(?![\p{L}\p{N}+/_-])",
    "name": _EDGE + f"(?:{_WOMEN}|{_MEN})" + r"\.? \p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_HINT = r"[0-9@]|[spr]k[-_]|gh[pousr]_|xox|AKIA|[0-9a-fA-F]{32}|" + f"{_WOMEN}|{_MEN}"  # every entity has one of these
_DIGITS_ONLY = ("phone", "ssn", "card")
# Syllables of invented names, by script; a name of a woman and of a man end differently.
_SYLLABLES = {
    "latin": ["ba", "den", "fi", "gor", "hal", "jo", "ka", "lin", "mo", "ner", "pol", "ri", "san", "to", "vel", "wi"],
    "cyrillic": ["ба", "ден", "фи", "гор", "хал", "жо", "ка", "лин", "мо", "нер", "пол", "ри", "сан", "то", "вел", "зи"],
    "greek": ["βα", "δεν", "φι", "γορ", "χαλ", "ζο", "κα", "λιν", "μο", "νερ", "πολ", "ρι", "σαν", "το", "βελ", "ξι"],
}
_ENDINGS = {"latin": ("a", "us"), "cyrillic": ("а", "ев"), "greek": ("α", "ος")}


def _characters(text: Column, turn) -> Column:
    """The text with every character replaced by ``turn(character, position from 1)``."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: turn(F.substring(text, i, F.lit(1)), i)), "")


def _kind(raw: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        out = F.when(raw.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _canonical(kind: Column, raw: Column) -> Column:
    title = F.when(raw.rlike(f"^{_WOMEN}"), F.lit("f:")).otherwise(F.lit("m:"))
    name = F.concat(title, F.lower(F.regexp_replace(raw, f"^(?:{_WOMEN}|{_MEN})" + r"\.? ", "")))
    digits = F.regexp_replace(raw, "[^0-9]", "")
    digits = F.concat(F.when((kind == "phone") & raw.startswith("+"), "+").otherwise(""), digits)
    return F.when(kind == "token", raw).when(kind == "iban", F.regexp_replace(raw, " ", "")).when(kind.isin(*_DIGITS_ONLY), digits).when(kind == "name", name).otherwise(F.lower(raw))


def _luhn(body: Column) -> Column:
    """The digit that makes ``body`` plus that digit a valid card number."""
    n = F.length(body)
    doubled = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: (lambda d: F.when((n - i) % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))(F.substring(body, i, F.lit(1)).cast("int")),
    )
    return ((10 - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string")


def _rest(text: Column) -> Column:
    """Rest of a bank account number by 97, letters as 10 to 35."""
    places = F.sequence(F.lit(1), F.length(text))
    values = F.transform(places, lambda i: F.conv(F.substring(text, i, F.lit(1)), 36, 10).cast("int"))
    return F.aggregate(values, F.lit(0), lambda a, x: F.when(x > 9, a * 100 + x).otherwise(a * 10 + x) % 97)


def _surrogate(kind: Column, canon: Column, attempt: int, key: str) -> Column:
    """Surrogate of the canonical form: same kind, length and format."""
    seed = F.concat_ws("|", F.lit(key), kind, F.lit(str(attempt)), canon)
    stream = F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("|more")), 512))
    pick = lambda text, i: F.substring(text, (i - 1) % 256 + 1, F.lit(1))
    digits, letters = F.translate(stream, "abcdef", "270495"), F.translate(stream, "0123456789abcdef", "bcdfghkmaeioulnr")
    number = lambda i: F.conv(F.substring(stream, i, F.lit(4)), 16, 10).cast("int")
    plain = lambda c, i: F.when(c.rlike("[0-9]"), pick(digits, i)).when(c.rlike(r"\p{L}"), pick(letters, i)).otherwise(c)

    zone = F.substring_index(canon, ".", -1)
    host = F.substring(canon, F.lit(1), F.length(canon) - F.length(zone))
    email = F.concat(_characters(host, plain), zone)

    def part(text: Column, i: Column) -> Column:
        n = number(i * 4 + 1)
        return F.when((F.length(text) >= 3) | F.lit(attempt >= ROUNDS), 100 + n % 156).when(F.length(text) == 2, 10 + n % 90).otherwise(n % 10).cast("string")

    ip = F.array_join(F.transform(F.split(canon, r"\."), part), ".")
    code = F.length(F.regexp_extract(canon, _CALLING, 0))
    country = F.when(code > 0, code).otherwise(F.greatest(F.length(canon) - 10, F.lit(0)))
    more = max(0, attempt - GROW + 1)  # digits beyond the original's
    tail = F.substring(digits, 150, more) if more else F.lit("")
    phone = F.concat(_characters(canon, lambda c, i: F.when(i <= country, c).otherwise(pick(digits, i))), tail)
    ssn = F.concat(_characters(canon, lambda c, i: pick(digits, i)), tail)
    body = F.substring(canon, F.lit(1), F.length(canon) - 1)
    drawn = F.concat(_characters(body, lambda c, i: F.when(i == 1, c).otherwise(pick(digits, i))), tail)
    valid = _luhn(body) == F.right(canon, F.lit(1))
    card = F.concat(drawn, F.when(valid, _luhn(drawn)).otherwise(pick(digits, F.length(canon))))
    ipv6 = _characters(canon, lambda c, i: F.when(c == ":", c).otherwise(pick(stream, i)))
    bank = _characters(F.substring(canon, F.lit(5), F.length(canon)), lambda c, i: F.when(c.rlike("[0-9]"), pick(digits, i)).otherwise(F.upper(pick(letters, i))))
    land = F.left(canon, F.lit(2))
    right = _rest(F.concat(F.substring(canon, F.lit(5), F.length(canon)), F.left(canon, F.lit(4)))) == 1
    made_check = F.lpad((98 - _rest(F.concat(bank, land, F.lit("00")))).cast("string"), 2, "0")
    iban = F.concat(land, F.when(right, made_check).otherwise(F.concat(pick(digits, F.lit(201)), pick(digits, F.lit(202)))), bank)
    prefix = F.length(F.regexp_extract(canon, "^(?:AKIA|[spr]k[-_]|gh[pousr]_|xox[abprs]-)", 0))
    token = _characters(
        canon, lambda c, i: F.when(i <= prefix, c).when(c.rlike("[0-9]"), pick(digits, i)).when(c.rlike("[a-z]"), pick(letters, i)).when(c.rlike("[A-Z]"), F.upper(pick(letters, i))).otherwise(c)
    )
    secret = _characters(canon, lambda c, i: pick(stream, i))

    script = F.when(canon.rlike(r"\p{IsCyrillic}"), "cyrillic").when(canon.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    words = F.split(F.substring(canon, F.lit(3), F.length(canon)), " ")

    def word(_: Column, i: Column) -> Column:
        made = F.lit("")
        for name, syllables in _SYLLABLES.items():
            row = F.array(*map(F.lit, syllables))
            drawn = F.concat(*[F.element_at(row, number(i * 128 + j * 4 + 1) % len(syllables) + 1) for j in range(min(3 + attempt, 30))])
            female, male = _ENDINGS[name]
            made = F.when(script == name, F.concat(drawn, F.when(canon.startswith("f:"), female).otherwise(male))).otherwise(made)
        return F.initcap(made)

    name = F.array_join(F.transform(words, word), " ")
    kinds = {"email": email, "ip": ip, "phone": phone, "ssn": ssn, "card": card, "secret": secret, "ipv6": ipv6, "iban": iban, "token": token}
    out = F.when(kind == "name", F.lower(F.concat(F.left(canon, F.lit(2)), name)))
    for value, made in kinds.items():
        out = out.when(kind == value, made)
    return F.when(kind.isin("name", "ip", *_DIGITS_ONLY), out).otherwise(F.concat(out, F.lit(f"-{attempt}"))) if attempt >= ROUNDS else out


def _written(kind: Column, raw: Column, made: Column) -> Column:
    """The surrogate in the format of this spelling: its grouping, case and form of address."""
    number, own = F.regexp_replace(made, r"^\+", ""), F.length(F.regexp_replace(raw, "[^0-9]", ""))
    digits = _characters(
        raw, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(number, F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), "[^0-9]", "")), F.lit(1))).otherwise(c)
    )
    digits = F.concat(digits, F.substring(number, own + 1, F.length(number)))  # a longer surrogate is not cut
    cased = F.concat(
        _characters(raw, lambda c, i: F.when(c.rlike(r"\p{Lu}"), F.upper(F.substring(made, i, F.lit(1)))).otherwise(F.substring(made, i, F.lit(1)))),
        F.substring(made, F.length(raw) + 1, F.length(made)),
    )
    title = F.regexp_extract(raw, f"^(?:{_WOMEN}|{_MEN})" + r"\.? ", 0)
    name = F.concat(title, F.initcap(F.substring(made, F.lit(3), F.length(made))))
    grouped = _characters(raw, lambda c, i: F.when(c == " ", c).otherwise(F.substring(made, F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), " ", "")), F.lit(1))))
    grouped = F.concat(grouped, F.substring(made, F.length(F.regexp_replace(raw, " ", "")) + 1, F.length(made)))
    return F.when(kind.isin(*_DIGITS_ONLY), digits).when(kind == "name", name).when(kind == "iban", grouped).when(kind == "token", made).otherwise(cased)


def found(text: str = "text") -> Column:
    """All entities of a text, in order."""
    return F.regexp_extract_all(F.col(text), F.lit(_ANY), F.lit(0))


def entities(docs: DataFrame) -> DataFrame:
    """(digest, pos, raw, kind, canon) of the entities of each distinct text."""
    rows = docs.where(F.col("text").rlike(_HINT)).select(F.sha2("text", 256).alias("digest"), F.posexplode(found()).alias("pos", "raw"))
    rows = rows.distinct().withColumn("kind", _kind(F.col("raw")))
    return rows.withColumn("canon", _canonical(F.col("kind"), F.col("raw")))


def surrogate_map(known: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canon, made): one surrogate for every (kind, canon), all different and none an entity itself, of any kind."""
    real = stored(known.select("kind", "canon").distinct(), "private-real")
    taken = real.select(F.col("canon").alias("made")).distinct()
    left, done, attempt = real, None, 0
    while True:
        # few bytes, much work: dealt by rows, which adaptive execution would not do
        dealt = left.repartition(max(1, -(-left.count() // TASK_ROWS)), "kind", "canon")
        tried = dealt.withColumn("made", _surrogate(F.col("kind"), F.col("canon"), attempt, key))
        free = tried.join(taken, "made", "left_anti")
        if done is not None:
            free = free.join(done.select("made"), "made", "left_anti")
        won = free.groupBy("made").agg(F.min(F.struct("kind", "canon")).alias("won")).select("won.kind", "won.canon", "made")
        won = stored(won, "private-won")
        done = won if done is None else stored(done.unionByName(won), "private-done")
        left = stored(left.join(won, ["kind", "canon"], "left_anti"), "private-left")
        if left.isEmpty():
            return done
        attempt += 1


def with_surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, n_entities and text, entities replaced."""
    docs = docs.select("doc_id", "text")
    known = stored(entities(docs), "private-entities")
    chosen = known.join(surrogate_map(known, key), ["kind", "canon"])
    chosen = chosen.select("digest", "pos", _written(F.col("kind"), F.col("raw"), F.col("made")).alias("new"))
    chosen = stored(chosen, "private-chosen").groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("pos", "new"))).alias("news"))
    chosen = stored(chosen, "private-texts")

    hinted = F.coalesce(F.col("text").rlike(_HINT), F.lit(False))
    with_hint = docs.where(hinted).withColumn("digest", F.sha2("text", 256)).join(chosen, "digest", "left")
    parts = F.split("text", _ANY, -1)
    text = F.array_join(F.zip_with(parts, F.col("news.new"), lambda p, n: F.concat(F.coalesce(p, F.lit("")), F.coalesce(n, F.lit("")))), "")
    some = F.col("news").isNotNull()
    changed = with_hint.select(
        "doc_id",
        F.when(some, F.size("news")).otherwise(0).cast("bigint").alias("n_entities"),
        F.when(some, text).otherwise(F.col("text")).alias("text"),
    )
    return docs.where(~hinted).select("doc_id", F.lit(0).cast("bigint").alias("n_entities"), "text").unionByName(changed)
