"""Surrogates for personal data and secrets, in DataFrame functions only (operator 7).

Entities are found by one pattern of alternatives. What identifies an entity is its key: an address in lower case, the digits
of a number, the family name and the given name of a person; so `Mr John Smith` and `Mr. Smith`, or one number written in
two ways, stay one entity (coreference). Each distinct key gets one surrogate, derived from a keyed hash: letters become
letters, digits digits; each kind has its own fixed parts, and the domain of an address its own surrogate. An entity is then
written in its own format: title, separators, groups, upper case. Two keys of one surrogate, or a surrogate that is itself
a key of the corpus, are a collision: the later one in order of text draws again until none is left. From the third draw on
a surrogate is longer by keyed characters, more with each draw, so there is always room for another.

Names without a title aren't found, as no pattern tells them from other words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.common import staged

#: Fixed: patterns by kind, tried in this order at each place.
PATTERNS = {
    # from the start of a run of its characters, or where the entity before ended, and without going back: linear in the text
    "email": r"(?:(?<![A-Za-z0-9._%+\-])|\G)[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "secret": r"\b[0-9a-f]{40}\b|\b[0-9a-f]{64}\b",
    "iban": r"\b[A-Z]{2}\d{2} ?[A-Z0-9]{4}(?: ?\d{4}){2,6}(?: ?\d{1,3})?\b",
    "ipv6": r"(?<![0-9A-Za-z:])(?=[A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![0-9A-Za-z:])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<![\d\-])\d{4}([ \-]?)\d{4}\1\d{4}\1\d{4}(?![\d])|(?<![\d\-])3[47]\d{13}(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?\(?\d{2,4}\)?[ .\-]?\d{3}[ .\-]?\d{3,4}(?!\d)|(?<![\w+])\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
    "name": r"(?<!\p{L})(?:Mr|Mrs|Ms|Mme|Herr|Frau|Señor|Señora|Monsieur|Madame|Г-н|Г-жа)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?(?!\p{L})",
}
#: What every entity of a kind contains; a text without any of these isn't searched.
HINTS = {"email": "@", "access_key": "AKIA|ASIA", "secret": "[0-9]|[a-f]{40}", "iban": "[0-9]", "ipv6": "[0-9A-Fa-f]:", "ip": "[0-9]", "card": "[0-9]", "ssn": "[0-9]", "phone": "[0-9]", "name": r"(?:Mr|Mrs|Ms|Mme|Herr|Frau|Señora?|Monsieur|Madame|Г-н|Г-жа)\.? "}
#: Fixed: titles that go with a man's name; the others go with a woman's.
MALE = ["Mr", "Herr", "Señor", "Monsieur", "Г-н"]
#: Fixed: letters and endings of made-up given names by script: three pairs of consonant and vowel, then an ending by gender; four million for each.
CONSONANTS, VOWELS = {"latin": "bdfghjklmnprstvz", "cyrillic": "бвгджзклмнпрстфх"}, {"latin": "aeiou", "cyrillic": "аеиоу"}
ENDINGS = {
    ("m", "latin"): ["n", "r", "s", "l", "m", "k", "d", "t"], ("f", "latin"): ["na", "la", "ra", "sa", "lia", "ria", "nia", "mia"],
    ("m", "cyrillic"): ["н", "р", "с", "л", "м", "к", "д", "т"], ("f", "cyrillic"): ["на", "ла", "ра", "са", "лия", "рия", "ния", "мия"],
}
#: Fixed: syllables of made-up family names.
SYLLABLES = {"latin": ["bar", "den", "fal", "gor", "hem", "kel", "lin", "mor", "nev", "pol", "ras", "sul", "tam", "ver", "wil", "zan"], "cyrillic": ["бар", "вел", "гор", "дан", "жел", "зим", "кор", "лап", "мор", "нов", "пол", "рад", "сол", "тим", "фед", "шар"]}
EVERY = "|".join(f"(?:{p})" if k != "card" else f"(?:{p.replace('(' + '[ ' + chr(92) + '-]?)', '(?<sep>[ ' + chr(92) + '-]?)').replace(chr(92) + '1', chr(92) + 'k<sep>')})" for k, p in PATTERNS.items())


def _kind(e: Column) -> Column:
    out = F.lit("phone")
    for k in ("name", "ssn", "card", "ip", "ipv6", "iban", "secret", "access_key", "email"):
        out = F.when(e.rlike(f"^(?:{PATTERNS[k]})$"), k).otherwise(out)
    return out


def _drawn(e: Column, d: Column, first: int = 0) -> Column:
    """e with digits and letters from the hex digits d, character by character; the first `first` characters stay."""
    chars = F.split(e, "")
    number = lambda i: F.conv(F.substring(d, F.pmod(3 * i, F.lit(125)) + 1, F.lit(3)), 16, 10).cast("int")

    def one(c: Column, i: Column) -> Column:
        n = number(i)
        letter = lambda a: F.char(n % 26 + a)
        return F.when(i < first, c).when(c.rlike("[0-9]"), (n % 10).cast("string")).when(c.rlike("[A-Z]"), letter(65)).when(c.rlike("[a-z]"), letter(97)).otherwise(c)

    return F.array_join(F.transform(chars, one), "")


def luhn(e: Column) -> Column:
    """Luhn sum of the digits of e modulo 10."""
    digits = F.reverse(F.split(F.regexp_replace(e, "[^0-9]", ""), ""))
    added = F.transform(digits, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((2 * c.cast("int")) % 10 + F.when(c.cast("int") > 4, 1).otherwise(0)))
    return F.aggregate(added, F.lit(0), lambda a, x: a + x) % 10


def _script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _keys(e: Column, kind: Column) -> Column:
    """The keys of an entity as an array of (kind, c): family and given name of a name, one key of others."""
    words = F.split(e, " ")
    family, given = F.element_at(words, -1), F.when(F.size(words) == 3, F.element_at(words, 2))
    gender = F.when(F.regexp_replace(F.element_at(words, 1), r"\.", "").isin(MALE), "m").otherwise("f")
    one = lambda k, c: F.struct(k.alias("kind"), c.alias("c"))
    names = F.array(one(F.concat(F.lit("family_"), _script(family)), family), one(F.concat(F.lit("given_"), gender, F.lit("_"), _script(given)), given))
    digits = F.regexp_replace(e, "[^0-9]", "")
    c = F.when(kind.isin("email", "secret", "ipv6"), F.lower(e)).when(kind.isin("card", "ssn"), digits).when(kind == "iban", F.translate(e, " ", ""))
    c = c.when(kind == "phone", F.concat(F.when(e.startswith("+"), "+").otherwise(""), digits)).otherwise(e)
    return F.when(kind == "name", F.filter(names, lambda x: x["c"].isNotNull())).otherwise(F.array(one(kind, c)))


def _checked(bban: Column, country: Column) -> Column:
    """Country, check digits and account: the whole, moved round and read in digits, leaves 1 modulo 97."""
    value = lambda acc, ch: F.when(ch.rlike("[0-9]"), (acc * 10 + ch.cast("int")) % 97).otherwise((acc * 100 + F.ascii(ch) - 55) % 97)
    rest = F.aggregate(F.filter(F.split(F.concat(bban, country, F.lit("00")), ""), lambda ch: ch != ""), F.lit(0), value)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), bban)


def _surrogate(kind: Column, c: Column, d: Column, dd: Column, x: Column) -> Column:
    """The surrogate of key c from the hex digits d, and dd for a domain, lengthened by the hex digits x, of which the first draws have none."""
    hexed = lambda at, n: F.conv(F.substring(d, at, n), 16, 10).cast("int")
    more, letters = F.translate(x, "abcdef", "012345"), F.translate(x, "0123456789abcdef", "abcdefghijklmnop")
    # the domain keeps its labels' lengths; its last label becomes a reserved one
    local, domain = F.substring_index(c, "@", 1), F.substring_index(c, "@", -1)
    labels = F.regexp_replace(domain, r"\.[^.]*$", "")
    email = F.concat(_drawn(local, d), letters, F.lit("@"), _drawn(labels, dd), F.lit(".example"))
    card0 = F.concat(_drawn(c, d, 1), more)
    # a card number that has a right check digit gets one: the last digit is set to what the sum asks for
    body = F.concat(card0.substr(F.lit(1), F.length(card0) - 1), F.lit("0"))
    card = F.when(luhn(c) == 0, F.concat(card0.substr(F.lit(1), F.length(card0) - 1), F.pmod(10 - luhn(body), F.lit(10)).cast("string"))).otherwise(card0)
    # the reserved block 240.0.0.0/4: no host has such an address; beyond it the documentation block 2001:db8::/32
    v6 = F.concat(F.lit("2001:db8"), F.regexp_replace(F.substring(d, 1, 24), "(.{4})", ":$1"))
    ip = F.concat_ws(".", (240 + hexed(1, 2) % 15).cast("string"), *[(hexed(3 + 3 * i, 3) % 256).cast("string") for i in range(3)])
    ip = F.when(x == "", ip).otherwise(v6)
    # calling codes that begin with 1 or 7 have one digit; of others two stay
    code = F.regexp_extract(c, r"^\+([17]|\d{2})", 1)
    phone = F.concat(code, _drawn(F.regexp_replace(c, r"^\+(?:[17]|\d{2})", ""), d), more)

    def pick(values: list[str], at: int) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), hexed(at, 2) % len(values) + 1)

    # a name grows by a syllable a draw
    own = F.substring(x, F.lit(1), F.expr("cast(length(x) div 8 as int)"))
    at = lambda text, i: F.lit(text).substr(i + 1, F.lit(1))
    pair = lambda s, i: F.concat(at(CONSONANTS[s], F.floor(hexed(i, 3) % 80 / 5).cast("int")), at(VOWELS[s], hexed(i, 3) % 5))
    further = lambda s: F.array_join(F.transform(F.split(own, ""), lambda ch: F.coalesce(F.element_at(F.array(*map(F.lit, SYLLABLES[s])), F.conv(F.when(ch != "", ch), 16, 10).cast("int") + 1), F.lit(""))), "")
    out = F.when(kind == "email", email).when(kind == "access_key", F.concat(F.substring(c, 1, 4), _drawn(F.substring(c, 5, 16), d), F.upper(letters)))
    out = out.when(kind == "secret", F.concat(F.substring(d, 1, F.length(c)), x)).when(kind == "ip", ip).when(kind == "ipv6", v6).when(kind == "card", card).when(kind == "phone", phone)
    out = out.when(kind == "iban", _checked(F.concat(_drawn(c.substr(F.lit(5), F.length(c)), d), more), F.substring(c, 1, 2)))
    for s in SYLLABLES:
        out = out.when(kind == f"family_{s}", F.initcap(F.concat(*[pick(SYLLABLES[s], 10 + 2 * i) for i in range(4)], further(s))))
        for g in ("m", "f"):
            out = out.when(kind == f"given_{g}_{s}", F.initcap(F.concat(*[pair(s, 30 + 3 * i) for i in range(3)], further(s), pick(ENDINGS[g, s], 40))))
    return out.otherwise(F.concat(_drawn(c, d), more))


def _written(e: Column, kind: Column, s: Column) -> Column:
    """Surrogates s of an entity's keys in the format of e."""
    one, chars = s[0], F.split(e, "")
    # digits are poured into the places of e's digits, those left over follow
    n = lambda i: F.length(F.regexp_replace(e.substr(F.lit(1), i), "[^0-9]", ""))
    poured = F.concat(F.array_join(F.transform(chars, lambda ch, i: F.when(ch.rlike("[0-9]"), one.substr(n(i + 1), F.lit(1))).otherwise(ch)), ""), one.substr(n(F.length(e)) + 1, F.lit(100)))
    grouped = F.when(e.contains(" "), F.rtrim(F.regexp_replace(one, "(.{4})", "$1 "))).otherwise(one)
    name = F.concat(F.regexp_extract(e, r"^([^ ]+ )", 1), F.when(F.size(s) == 2, F.concat(s[1], F.lit(" "))).otherwise(""), s[0])
    cased = F.when((e == F.upper(e)) & (e != F.lower(e)), F.upper(one)).otherwise(one)
    return F.when(kind == "name", name).when(kind.isin("phone", "card", "ssn"), poured).when(kind == "iban", grouped).when(kind == "email", cased).otherwise(one)


def _drawn_keys(keys: DataFrame, secret: str) -> DataFrame:
    """(kind, c, s) for distinct keys (kind, c): no two share a surrogate and none is itself a key."""

    def drawn(f: DataFrame) -> DataFrame:
        seed = lambda part, *of: F.sha2(F.concat_ws("\x1f", F.lit(secret), F.lit(part), *of).cast("binary"), 256)
        own = ("kind", "c", F.col("draw").cast("string"))
        # none in draws 0 and 1, then 8 hex digits more each draw, 64 at most: 2^256 surrogates
        longer = seed("c", *own).substr(F.lit(1), F.greatest(F.lit(0), F.least(F.lit(64), 8 * (F.col("draw") - 1))))
        domain = F.substring_index("c", "@", -1)
        d = f.withColumn("d", F.concat(seed("a", *own), seed("b", *own))).withColumn("dd", F.concat(seed("d", domain), seed("e", domain))).withColumn("x", longer)
        return d.select("kind", "c", "draw", _surrogate(F.col("kind"), F.col("c"), F.col("d"), F.col("dd"), F.col("x")).alias("s"))

    held = staged(drawn(keys.select("kind", "c").distinct().withColumn("draw", F.lit(0))), "surrogates")
    while True:
        taken = held.groupBy("s").agg(F.min("c").alias("first"), F.count(F.lit(1)).alias("n"))
        several = held.join(taken.where("n > 1"), "s")
        # of one key under two kinds the later kind draws again
        first = several.groupBy("s").agg(F.min(F.struct("c", "kind")).alias("keeps"))
        clash = several.join(first, "s").where("c <> keeps.c or kind <> keeps.kind").select("kind", "c")
        clash = clash.unionByName(held.join(held.select(F.col("c").alias("s")).distinct(), "s", "left_semi").select("kind", "c")).distinct()
        clash = staged(clash, "clashes")
        if clash.isEmpty():
            return held.select("kind", "c", "s")
        again = drawn(held.join(clash, ["kind", "c"], "left_semi").select("kind", "c", (F.col("draw") + 1).alias("draw")))
        held = staged(held.join(clash, ["kind", "c"], "left_anti").unionByName(again), "surrogates")


def surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """(e, kind, s) for distinct entities e: their surrogates, in their own formats."""
    kind = entities.select("e").distinct().select("e", _kind(F.col("e")).alias("kind"))
    each = staged(kind.select("e", "kind", F.posexplode(_keys(F.col("e"), F.col("kind"))).alias("at", "key")).select("e", F.col("kind").alias("of"), "at", "key.kind", "key.c"), "keys")
    given = each.join(_drawn_keys(each, secret), ["kind", "c"])
    parts = given.groupBy("e").agg(F.first("of").alias("kind"), F.sort_array(F.collect_list(F.struct("at", "s")))["s"].alias("ss"))  # two at most
    return parts.select("e", "kind", _written(F.col("e"), F.col("kind"), F.col("ss")).alias("s"))


def replace_entities(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with every entity in `text` replaced, and n_entities; all other columns stay.

    Null text stays null and empty text empty, with no entities. Rows need no key and may repeat: each gets the surrogates
    of its own entities. An empty table gives none. A column n_entities of docs is replaced.

    The pattern is applied once to every text that has a hint of an entity, and the result is written. Documents without
    an entity are done then; only the others are joined with their surrogates, row by row.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    names = [f"c{i}" for i in range(len(columns))]
    t = F.col(names[columns.index(text)])
    found = F.when(t.rlike("|".join(dict.fromkeys(HINTS.values()))), F.regexp_extract_all(t, F.lit(EVERY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)])
    rows = staged(rows.withColumn("es", F.coalesce(found, F.array().cast("array<string>"))).withColumn("row", F.monotonically_increasing_id()), "entities")
    some = rows.where(F.size("es") > 0)
    each = some.select("row", F.explode(F.array_distinct("es")).alias("e"))
    given = staged(surrogates(each, secret), "given")
    maps = staged(each.join(given, "e").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("e", "s"))).alias("m")), "maps")  # a text's own entities
    parts = F.split(t, EVERY, -1)
    new = F.array_join(F.zip_with(parts, "es", lambda p, e: F.concat(p, F.coalesce(F.element_at(F.col("m"), e), e, F.lit("")))), "")
    done = some.join(maps, "row").withColumn(names[columns.index(text)], new)
    out = done.select(*names, F.size("es").cast("long").alias("n")).unionByName(rows.where(F.size("es") == 0).select(*names, F.lit(0).cast("long").alias("n")))
    return out.toDF(*columns, "n_entities")
