"""Personal data replaced by surrogates, in DataFrame operations only.

Addresses, numbers, secrets and names are found by patterns and checks. Every distinct entity of
the table gets one surrogate from a keyed hash: of the same type, format and script, names of
the same gender. Surrogates are compared over the whole table; an entity whose surrogate
is taken, or is itself an entity of the table, draws again, and after some draws from a larger
space. So different entities stay different, and one entity is the same everywhere, in
whatever format it is written. A name that is found once in a text is replaced in all of it, also
where it stands alone.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.llm.common import stored

#: Fixed given names by gender and script; a surrogate is another one of the same list.
GIVEN = {
    "female-latin": "Alice Anna Barbara Carla Diana Emma Helena Ingrid Julia Laura Maria Nina Olivia Petra Sarah Teresa".split(),
    "male-latin": "Albert Boris Carlos David Erik Frank George Henry Jack James John Karl Martin Oscar Peter Thomas".split(),
    "female-cyrillic": "Анна Вера Елена Ирина Мария Нина Ольга Татьяна".split(),
    "male-cyrillic": "Алексей Борис Виктор Дмитрий Иван Николай Павел Сергей".split(),
    "female-greek": "Άννα Ελένη Ειρήνη Κατερίνα Μαρία Σοφία".split(),
    "male-greek": "Αλέξανδρος Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
}
#: Fixed forms of address; a capitalised word behind one is a family name.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora Господин Госпожа Κύριος Κυρία".split()
#: Syllables of made-up family names.
SYLLABLES = {
    "latin": "bar den fol gar hol jas kel lam mor nor pel quin ros sten tal var wen zim".split(),
    "cyrillic": "бар вел гор дан жел зор кам лот мир нор пет руд сав тол".split(),
    "greek": "βαρ γορ δελ ζαν καλ λον μαρ νικ παν ρος σαλ τιμ".split(),
}
#: Draws from the space of the entity's own format; as many later ones may be longer or from a larger space.
DRAWS = 6
#: What comes before a name of whatever list, in any letter case; a fixed list.
CUES = "my name is|name:|author:|attn:|signed by|contact person:|written by"

#: A name has 127 labels at most; a bound, as Java recurses over such groups.
_EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}+"
_IP = r"(?:\d{1,3}\.){3}\d{1,3}"
_PHONE = r"\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_CARD = r"\d(?:[ -]?\d){12,18}"
_SECRET = r"[0-9A-Za-z_+/-]++(?:\.[0-9A-Za-z_+/-]++)*+"
#: White space that may stand between a label and its secret (a bound, as Java looks back so far at most).
_GAP = r"\s{0,200}"
_SECRET_LABEL = r"(?i:token|secret|password|passwd|api[ _-]?key|access[ _-]?key)"
_SECRET_BEFORE = rf"(?:(?<={_SECRET_LABEL}[\"']?{_GAP}[=:]{_GAP}[\"']?)|(?<=(?i:bearer)\s{_GAP}))"
#: Secrets known by their form: key ids, access tokens, signed tokens.
_FORMED = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[0-9A-Za-z]{30,}+"
    r"|eyJ[0-9A-Za-z_-]{8,}+\.[0-9A-Za-z_-]++(?:\.[0-9A-Za-z_-]++)?+"
)
_IP6 = r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}"
#: Country, check digits and up to 30 more, in groups of four or together.
_IBAN = r"[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?"
#: Behind a label of a password stands one, however short; in quotes it goes up to the closing one.
#: A word of small letters with another behind it is prose ("password: reset it"), in no quotes.
_PASSWORD = r"(?:(?<=\")[^\"\n]++(?=\")|(?<=')[^'\n]++(?=')|(?![a-z]++ ++[a-z])[^\s\"'<>]*[^\s\"'<>.,;:)])"
_PASSWORD_BEFORE = rf"(?<=(?i:password|passwd)[\"']?{_GAP}[=:]{_GAP}[\"']?)"


def _patterns() -> tuple[str, str]:
    """What may hold an entity at all, and the entities; the group is a secret."""
    given = "|".join(n for names in GIVEN.values() for n in names)
    titles = "|".join(TITLES)
    # more parts may follow, but not the s of a genitive
    word = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}[\p{L}\p{M}]*+(?:[-'’](?!s(?!\p{L}))\p{L}[\p{L}\p{M}]*+)*+"
    first = rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{given})(?= {word})"
    last = rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{given}) |(?<!\p{{L}})(?:{titles})\.? ){word}"
    # behind a cue stand up to three words of a name
    part, cue = r"\p{Lu}[\p{L}'’-]{1,40} ", rf"(?<!\p{{L}})(?i:{CUES})\s{{1,3}}"
    cued = rf"(?=\p{{Lu}})(?:(?<={cue})|(?<={cue}{part})|(?<={cue}{part}{part})){word}"
    numbers = rf"(?<![\w.+@-])(?=[+(\d])(?:{_PHONE}|{_SSN}|{_IP}|{_CARD})(?![\w@]|[.-]\d)"
    coded = rf"(?<![\w:.])(?:(?=[0-9A-Fa-f]{{1,4}}:)(?:{_IP6})(?![\w:])|(?=[A-Z]{{2}}\d{{2}})(?:{_IBAN})(?![0-9A-Za-z]))"
    formed = rf"(?<![0-9A-Za-z_])(?=AKIA|ASIA|gh|eyJ)(?:{_FORMED})"
    email = rf"(?<![A-Za-z0-9._%+-])(?=[A-Za-z0-9]){_EMAIL}"
    secret = rf"(?<![0-9A-Za-z_+/-])(?=[0-9A-Za-z_+/.-]{{16}}){_SECRET_BEFORE}{_SECRET}"
    password = rf"(?<=[=:\s\"'])(?=[^\s\"'<>]){_PASSWORD_BEFORE}{_PASSWORD}"
    maybe = (
        rf"@|\d[\d ().-]{{5,}}\d|(?i:token|secret|passw|api.?key|access.?key|bearer|{CUES})|AKIA|ASIA|gh[pousr]_|eyJ|[0-9A-Fa-f]:[0-9A-Fa-f:]{{1,4}}:|[A-Z]{{2}}\d\d ?[0-9A-Z]{{4}}|(?<!\p{{L}})(?=\p{{Lu}})(?:{titles}|{given})\.? \p{{Lu}}"
    )
    return maybe, rf"{email}|({password}|{secret}|{formed})|{coded}|{numbers}|{first}|{last}|{cued}"


MAYBE, ENTITY = _patterns()

#: Words that may be a name: with parts joined by hyphens, without the s of a genitive.
NAME = r"(?<![\p{L}\p{M}])\p{Lu}['’]?[\p{L}\p{M}]++(?:[-'’](?!s(?!\p{L}))\p{L}[\p{L}\p{M}]*+)*+"


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, r"\D", "")


def _mod97(text: Column) -> Column:
    """Digits and capitals as one number (A is 10), modulo 97."""
    digit = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""),
        F.lit(0),
        lambda sum_, c: ((sum_ * F.when(digit(c) < 10, 10).otherwise(100) + digit(c)) % 97).cast("int"),
    )


def _plain(raw: Column) -> Column:
    return F.replace(raw, F.lit(" "))


def _iban_rest(value: Column, checks: Column) -> Column:
    """What the check of an account number is over: its country and check digits go last."""
    return F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 2), checks)


def kind_of(raw: Column, secret: Column) -> Column:
    """Type of a match, null if it is a number that a check says to be none.

    What is not a ``secret`` by its place is an address or number by its form, or else a name.
    """
    whole = lambda p: raw.rlike(rf"^(?:{p})$")
    octets = F.transform(F.split(raw, r"\."), lambda o: o.cast("int"))
    kind = F.when(secret, F.lit("secret")).when(whole(_EMAIL), F.lit("email"))
    kind = kind.when(whole(_IP), F.when(F.forall(octets, lambda o: o < 256), F.lit("ip")))
    kind = kind.when(whole(_IP6), F.lit("ip6"))
    kind = kind.when(whole(_IBAN), F.when(_mod97(_iban_rest(_plain(raw), F.substring(_plain(raw), 3, 2))) == 1, F.lit("iban")))
    kind = kind.when(whole(_SSN), F.lit("ssn"))
    kind = kind.when(whole(_PHONE) & F.length(_digits(raw)).between(9, 15), F.lit("phone"))
    # issuers begin with 2 to 6, and the last digit is a check digit
    kind = kind.when(whole(_CARD), F.when(_digits(raw).rlike("^[2-6]") & F.call_function("luhn_check", _digits(raw)), F.lit("card")))
    for name, names in GIVEN.items():
        kind = kind.when(raw.isin(*names), F.lit(name))
    kind = kind.when(raw.rlike(r"^\p{IsCyrillic}"), F.lit("family-cyrillic"))
    kind = kind.when(raw.rlike(r"^\p{IsGreek}"), F.lit("family-greek"))
    # names in other scripts get a Latin one
    return kind.when(raw.rlike(r"^\p{L}"), F.lit("family-latin"))


def _normal(kind: Column, raw: Column) -> Column:
    """One spelling of an entity: what its surrogate depends on."""
    return (
        F.when(kind == "email", F.lower(raw))
        .when(kind.isin("phone", "card", "ssn"), _digits(raw))
        .when(kind == "iban", _plain(raw))
        .when(kind == "ip6", F.lower(raw))
        .otherwise(raw)
    )


def _draw(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """A surrogate of a normal spelling."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")), 256)
    number = lambda i, n: F.pmod(F.xxhash64(seed, i), F.lit(n))
    one_of = lambda text, i: F.substring(F.lit(text), (number(i, len(text)) + 1).cast("int"), F.lit(1))
    run = lambda n, f: F.array_join(F.transform(F.sequence(F.lit(1), n), f), "")

    def alike(text: Column, hexadecimal: Column) -> Column:
        """Digits for digits, letters for letters (Latin ones), everything else as it is."""
        lower = lambda i: F.when(hexadecimal, one_of("abcdef", i)).otherwise(one_of("abcdefghijklmnopqrstuvwxyz", i))
        return F.array_join(
            F.transform(
                F.split(text, ""),
                lambda c, i: F.when(c.rlike("[0-9]"), one_of("0123456789", i))
                .when(c.rlike("[a-z]"), lower(i))
                .when(c.rlike("[A-Z]"), F.upper(lower(i)))
                .when(c.rlike(r"\p{L}"), lower(i))
                .otherwise(c),
            ),
            "",
        )

    # later draws are longer, so that no space is used up
    extra = F.when(attempt < DRAWS, F.lit("")).otherwise(run(attempt - DRAWS + 2, lambda i: one_of("0123456789", -i)))
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.substring_index(value, "@", -1)), 256)
    letters = F.translate(F.substring(domain, 1, 8), "0123456789", "ghijklmnop")
    email = F.concat(
        alike(F.substring_index(value, "@", 1), F.lit(False)), extra, F.lit("@"), letters, F.lit(".example."),
        F.substring_index(value, ".", -1),
    )
    size = F.length(value)
    digit = lambda i: one_of("0123456789", i)
    # a country code stays, and 555 is the exchange of made-up numbers
    code = F.greatest(F.lit(0), size - 10)
    phone = F.when(
        size >= 10,
        F.concat(
            F.substring(value, F.lit(1), code),
            one_of("23456789", F.lit(1)),
            digit(F.lit(2)),
            digit(F.lit(3)),
            F.when(attempt < DRAWS, F.lit("555")).otherwise(run(F.lit(3), lambda i: digit(i + 7))),
            run(F.lit(4), lambda i: digit(i + 3)),
        ),
    ).otherwise(F.concat(one_of("23456789", F.lit(0)), run(size - 1, digit)))
    ssn = F.concat(F.when(attempt < DRAWS, F.lit("9")).otherwise(digit(F.lit(0))), run(size - 1, digit))
    ip6 = F.concat(F.when(value.rlike("^[0-9a-f]{4}:"), F.lit("fd")).otherwise(F.lit("")), alike(F.when(value.rlike("^[0-9a-f]{4}:"), F.substring(value, F.lit(3), size)).otherwise(value), F.lit(True)))
    account = alike(F.substring(value, F.lit(5), size), F.lit(False))
    account = F.concat(F.substring(value, 1, 2), F.lit("00"), account)
    checks = F.lpad((98 - _mod97(_iban_rest(account, F.lit("00")))).cast("string"), 2, "0")
    iban = F.concat(F.substring(value, 1, 2), checks, F.substring(account, F.lit(5), size))
    start = F.concat(F.substring(value, 1, 1), run(F.greatest(size - 2, F.lit(1)), digit))
    card = F.concat(
        start, F.element_at(F.filter(F.array(*[F.lit(str(d)) for d in range(10)]), lambda d: F.call_function("luhn_check", F.concat(start, d))), 1)
    )
    octet = lambda i, n=256: number(F.lit(i), n).cast("string")
    ip = F.concat_ws(
        ".", F.when(attempt < DRAWS, F.lit("10")).otherwise((number(F.lit(4), 223) + 1).cast("string")), octet(1), octet(2), octet(3)
    )
    pick = lambda pool, n: lambda i: F.element_at(pool, (number(i, n) + 1).cast("int"))
    made = {}
    for script, syllables in SYLLABLES.items():
        pool = F.array(*[F.lit(s) for s in syllables])
        count = F.lit(3) + F.greatest(F.lit(0), attempt - 1)
        name = F.initcap(run(count, pick(pool, len(syllables))))
        if script == "cyrillic":
            # the ending of a family name shows the gender
            name = F.concat(name, F.regexp_extract(value, "(ова|ева|ина|ская|ов|ев|ин|ский)$", 1))
        made[script] = name
    result = F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card)
    result = result.when(kind == "ip", ip).when(kind == "ssn", ssn).when(kind == "ip6", ip6).when(kind == "iban", iban)
    for script, name in made.items():
        result = result.when(kind == f"family-{script}", name)
    for kind_name, names in GIVEN.items():
        ring = sorted(names, key=lambda n: hashlib.sha256(f"{key}|{n}".encode()).digest())
        for this, other in zip(ring, ring[1:] + ring[:1], strict=True):
            result = result.when((kind == kind_name) & (value == this), F.lit(other))
    return result.otherwise(F.concat(alike(value, value.rlike("^[0-9a-fA-F]+$")), extra))


def _written(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the match: its digits in place, capitals if it has no other letters."""
    chars = F.split(raw, "")
    # digits before each place
    before = lambda i: F.length(_digits(F.substring(raw, F.lit(1), i + 1)))
    filled = F.array_join(
        F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(surrogate, before(i), F.lit(1))).otherwise(c)), ""
    )
    return (
        F.when(kind.isin("phone", "card", "ssn"), filled)
        # groups of four as the match has them
        .when((kind == "iban") & raw.contains(" "), F.rtrim(F.regexp_replace(surrogate, "(.{4})", "$1 ")))
        .when((kind == "ip6") & (raw == F.upper(raw)), F.upper(surrogate))
        .when((kind == "email") & (raw == F.upper(raw)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, value, surrogate)`` for the distinct ``(kind, value)``, without collisions.

    Given names are moved along a keyed ring of their list, which has no collisions but reuses
    names that occur; all other surrogates differ from each other and from every entity. Where a
    space is used up (numbers of one length and country, say), what is left after three
    times ``DRAWS`` draws exchanges its values, which differ from all other surrogates.
    """
    values = entities.select("kind", "value").distinct()
    rings = F.col("kind").isin(*GIVEN)
    done = values.filter(rings).withColumn("surrogate", _draw(F.col("kind"), F.col("value"), F.lit(0), key))
    taken = stored(values.filter(~rings), "entities")
    todo, attempt = taken, 0
    while attempt < 3 * DRAWS and not todo.isEmpty():
        drawn = todo.withColumn("surrogate", _draw(F.col("kind"), F.col("value"), F.lit(attempt), key))
        free = drawn.join(
            taken.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti"
        ).join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        # of entities with one surrogate, the first keeps it
        won = stored(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")), "surrogates")
        done = done.unionByName(won)
        todo = stored(todo.join(won, ["kind", "value"], "left_anti"), "entities")
        attempt += 1
    if todo.isEmpty():
        return done
    return done.unionByName(_exchanged(todo, key))


#: Parts that what is left is dealt to; a bound on no more than how many tasks work at it.
_PARTS = 1 << 10


def _exchanged(left: DataFrame, key: str) -> DataFrame:
    """Entities of an exhausted space exchange their values along keyed rings.

    No surrogate is an entity of the table, so the values of what is left are free. Entities of a
    ring are of one kind, length and beginning; a lone one gets its digits and letters turned by one.
    """
    order = F.sha2(F.concat_ws("|", F.lit(key), "kind", "value"), 256)
    alike = [F.col("kind"), F.length("value").alias("size"), F.substring("value", 1, 1).alias("start")]
    ring = Window.partitionBy("kind", "size", "start", "part").orderBy("order")
    size = left.groupBy(*alike).agg(F.ceil(F.count("*") / 4096).alias("parts"))
    dealt = left.select("*", *alike[1:], order.alias("order")).join(size, ["kind", "size", "start"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("order"), F.least("parts", F.lit(_PARTS)))).select(
        "kind", "value", F.coalesce(F.lead("value").over(ring), F.first("value").over(ring)).alias("next")
    )
    turned = F.translate("value", "0123456789abcdefghijklmnopqrstuvwxyz", "1234567890bcdefghijklmnopqrstuvwxyza")
    return dealt.select("kind", "value", F.when(F.col("next") == F.col("value"), turned).otherwise(F.col("next")).alias("surrogate"))


#: Stands between the parts of a text: a code point that is no character.
_MARK = "\uffff"


def _parts_of(text: Column) -> Column:
    """A text taken apart by one search: a gap, then for each entity what makes it a secret (or an empty
    text), the entity, and the gap behind it. Null without entities."""
    once = F.split(F.regexp_replace(text, ENTITY, f"{_MARK}$1{_MARK}$0{_MARK}"), _MARK, -1)
    # a text that holds the mark itself is searched for gaps, entities and secrets one after the other
    secrets, entities = (F.regexp_extract_all(text, F.lit(ENTITY), F.lit(group)) for group in (1, 0))
    behind = F.zip_with(F.arrays_zip(secrets.alias("s"), entities.alias("e")), F.slice(F.split(text, ENTITY, -1), 2, 1 << 30),
                        lambda m, gap: F.array(m["s"], m["e"], gap))
    apart = F.concat(F.slice(F.split(text, ENTITY, -1), 1, 1), F.flatten(behind))
    parts = F.when(text.contains(_MARK), apart).otherwise(once)
    return F.element_at(F.transform(F.array(parts), lambda p: F.when(F.size(p) > 1, p)), 1)


def with_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """``(row, masked, replaced)`` for each row of ``docs``: all columns as they were, the text
    with surrogates, and the number of replacements.

    ``key`` decides the surrogates; without it they cannot be tied to the entities. A null text
    stays null, an empty one empty, and a text without entities as it is. Copies of a text are
    replaced alike. An empty table gives an empty result.
    """
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text")
    )
    # the patterns are most of the work, so a text is taken apart once and the parts of all rows are kept
    looked = stored(whole.select("row", F.when(F.col("text").rlike(MAYBE), _parts_of(F.col("text"))).alias("parts")), "matches")
    found = (
        looked.filter("parts IS NOT NULL")
        .withColumn("text", F.col("row.text").cast("string"))
        # copies share the work
        .withColumn("key", F.sha2("text", 256))
        # each match behind a sign that says whether it is a secret by its place
        .withColumn(
            "matches",
            F.expr("transform(sequence(2, size(parts) - 2, 3), i -> if(parts[i - 1] != '', 's', '-') || parts[i])"),
        )
        .withColumn("gaps", F.expr("filter(parts, (part, i) -> i % 3 = 0)"))
        .drop("parts")
    )
    raws = found.select(F.explode(F.array_distinct("matches")).alias("raw")).distinct()
    match = F.expr("substring(raw, 2)")
    entities = stored(
        raws.withColumn("kind", kind_of(match, F.col("raw").startswith("s")))
        .filter("kind is not null")
        .withColumn("value", _normal(F.col("kind"), match)),
        "raws",
    )
    written = entities.join(assign(entities, key), ["kind", "value"]).select(
        "raw",
        _written(F.col("kind"), match, F.col("surrogate")).alias("other"),
        (F.col("kind").startswith("family-") | F.col("kind").isin(*GIVEN)).alias("named"),
    )
    maps = (
        found.dropDuplicates(["key"])
        .select("key", F.explode(F.array_distinct("matches")).alias("raw"))
        .join(written, "raw")
        .groupBy("key")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("raw", "other"))).alias("others"),
            F.map_from_entries(
                F.collect_list(F.when(F.col("named"), F.struct(match.alias("name"), "other")))
            ).alias("names"),
        )
    )
    known = lambda w: F.element_at("names", w)
    # a word of several parts is looked up whole, then by its parts
    parts = lambda w: F.split(w, r"(?<=[-'’])|(?=[-'’])")
    renamed = lambda w: F.coalesce(known(w), F.array_join(F.transform(parts(w), lambda x: F.coalesce(known(x), x)), ""))
    hits = lambda w: F.when(known(w).isNotNull(), 1).otherwise(F.size(F.filter(parts(w), lambda x: known(x).isNotNull())))
    words_of = lambda gap: F.regexp_extract_all(gap, F.lit(NAME), F.lit(0))

    def without_names(gap: Column) -> Column:
        """Text between matches, with the names that were found in the same text replaced."""
        between = F.split(gap, NAME, -1)
        words = F.concat(F.transform(words_of(gap), renamed), F.array(F.lit("")))
        return F.array_join(F.zip_with(between, words, lambda x, w: F.concat(x, w)), "")

    some = F.size("names") > 0
    masked = F.concat(
        F.element_at("gaps", 1),
        F.array_join(
            F.transform(
                "matches",
                lambda m, i: F.concat(F.coalesce(F.element_at("others", m), F.substr(m, F.lit(2))), F.element_at("gaps", (i + 2).cast("int"))),
            ),
            "",
        ),
    )
    changed = (
        found.join(maps, "key", "left")
        .withColumn(
            "again",
            F.when(some, F.aggregate(F.flatten(F.transform("gaps", words_of)), F.lit(0), lambda n, w: n + hits(w))).otherwise(0),
        )
        .withColumn("gaps", F.when(some, F.transform("gaps", without_names)).otherwise(F.col("gaps")))
        .select(
            "row",
            F.when(F.col("others").isNull(), F.col("text")).otherwise(masked).alias("masked"),
            F.when(F.col("others").isNull(), F.lit(0))
            .otherwise(F.size(F.filter("matches", lambda m: F.element_at("others", m).isNotNull())) + F.col("again"))
            .alias("replaced"),
        )
    )
    rest = looked.filter("parts IS NULL").select("row", F.col("row.text").cast("string").alias("masked"), F.lit(0).alias("replaced"))
    return rest.unionByName(changed)
