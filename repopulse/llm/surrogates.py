"""PII: detected entities are replaced by keyed surrogates of the same type, gender, script and format.

Built-in functions only. One pattern cuts a text into gaps and entities. Entities are reduced to
units in canonical form (an address in lower case, a number without separators, each word of a
name by itself), so mentions of one entity in any spelling share a unit. The distinct units get
surrogates from a keyed digest; a surrogate that two units share, or that is itself a unit of the
corpus, is drawn again until none is left. The surrogates then take the spelling of each mention.

Units are made distinct before they are shuffled, by text and over the corpus, and joined by plain
equi-joins whose hot partitions Spark can split: an address that fills a third of the corpus is one
unit. What is gathered for one text is bounded by that text.

A name is found behind a title or a degree. Its words are then replaced wherever they stand capitalised in the
same text, with the title or without; such mentions count as entities.

Null texts stay null; texts without entities come back byte for byte. Copies of a text get equal
results. Columns other than the text are kept; n_entities and entity_kinds are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.columns import let
from repopulse.session import settle

#: Titles before names, by the gender they tell.
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Госпожа",
    "m": "Mr Herr Monsieur Señor Sr Господин",
}
#: Not characters; they mark where a name begins while a text is cut: of a gender that is told, or behind a degree alone.
MARKS = {"f": "﷐", "m": "﷑", "n": "﷒"}
_MARK = "".join(MARKS.values())
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_ALL_TITLES = "|".join(" ".join(TITLES.values()).split())
#: Degrees that may stand between a title and the name.
_DEGREES = "Dr|Prof|Professor|Professorin|Professeur|Profesor|Profesora|Doktor|Doctor|Docteur|Doctora|Ing|Mag|Dipl|Доктор|доктор|Профессор|профессор"
_STACKED = rf"(?:(?:(?:{_DEGREES})(?:\.[ -]?|[ -])(?:(?:\p{{Ll}}{{1,4}}\.)+ ?)*|(?:{_ALL_TITLES})\.? ))*"
#: Degrees that stand for a title where there is none.
_ALONE = r"(?:Dr|Prof)\.?|Professor(?:in)?|Professeur|Profesora?|Doktor|Docteur|Doctora?|Доктор|Профессор"
_PARTICLES = (
    r"(?:(?:van(?: de[rnt]?| het)?|von(?: und zu| zu[rm]?| de[rnm])?|vom|de(?: la| las| los)?|del|della|di|da|do|dos|du|la|le|te[rn]|af|av"
    r"|bin|ibn|al|el|фон|ван|де) |[dl]['’])*+"
)
#: A part of a name that is replaced by itself.
NAME_WORD = r"\p{Lu}[\p{L}\p{M}]*+(?:['’]\p{Lu}[\p{L}\p{M}]*+)*+"
_NO_TITLE = rf"(?!(?:{_ALL_TITLES}|{_DEGREES})(?![\p{{L}}\p{{M}}]))"
#: Between two words of a name; a point stands behind initials only.
_BETWEEN = r"(?:(?<=[^\p{L}\p{M}]\p{Lu})\. ?| |-)"
#: Repeats are possessive: Java matches these in a loop, others by recursion, which a very long name would overflow.
_NAME = rf"{_PARTICLES}{_NO_TITLE}{NAME_WORD}(?:{_BETWEEN}{_PARTICLES}{_NO_TITLE}{NAME_WORD})*+"
#: A word of a text that may repeat one of its names.
MENTION = rf"(?<![\p{{L}}\p{{M}}\p{{N}}]){NAME_WORD}(?![\p{{N}}_])"
#: Latin, Greek and Cyrillic letters that an address may have, with marks on letters, and what stands before its at sign.
#: Ranges, because Java looks up the script of every character; assertions below begin with the cheapest.
_SCRIPTS = r"A-Za-z\u00C0-\u024F\u0300-\u03FF\u0400-\u052F\u1E00-\u1FFF"
_LOCAL = rf"{_SCRIPTS}0-9._%+-"
#: In order of precedence where two could start at the same place.
PATTERNS = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]*[{_SCRIPTS}0-9]@[{_SCRIPTS}0-9-]+(?:\.[{_SCRIPTS}0-9-]*[{_SCRIPTS}0-9])+",
    "secret": rf"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{20,}}|github_pat_\w{{22,}}|glpat-[\w-]{{20,}}|hf_[A-Za-z0-9]{{30,}}"
    r"|sk-[A-Za-z0-9]{20,}|sk-(?:proj|ant)-[\w-]{20,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[\w-]{30,}"
    r"|eyJ[\w-]{10,}\.[\w-]{10,}\.[\w-]*+|[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])"
    r"|(?<=[rR] )(?<=(?<![A-Za-z])(?i:bearer) )(?=[^\s\d]{0,200}\d)[\w.~+/-]{16,}+=*+"
    rf"|(?<=[=:\"' ])(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey) ?[=:] ?[\"']?)[^\s\"'{_MARK}]{{6,}}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": r"(?=[0-9A-Fa-f])(?<![\w:.])(?=[A-Fa-f:]{0,30}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]|\.\d)",
    "ip": rf"(?=\d)(?<![\d.vV])(?<!(?i:version|release|section|chapter|v\.) ?)(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-])"
    # National numbers, from a leading zero on: area and number, three or four groups, or five pairs.
    r"|(?=[0(])(?<![\w.,:/-])(?:0[1-9]\d{0,4}[ /-]|\(0[1-9]\d{0,4}\) ?)\d{5,8}(?![\w/:-]|[.,]\d)"
    r"|(?=[0(])(?<![\w.,:/-])(?:0[1-9]\d{1,4}|\(0[1-9]\d{1,4}\))(?:[ /-]\d{3,4}){2,3}(?![\w/:-]|[., ]\d)"
    r"|(?=0)(?<![\w.,:/-])0[1-9](?:(?: \d\d){4}|(?:\.\d\d){4}|(?:-\d\d){4})(?![\w/:-]|[., ]\d)",
    "person": rf"[{_MARK}]{_NAME}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these holds no entity; most texts are not searched further. Secrets of letters alone hold no digit.
HINT = (
    rf"[0-9@{_MARK}]|(?i:password|passwd|pwd|secret|token|api_key|apikey) ?[=:]"
    r"|AKIA[A-Z]{16}|gh[pousr]_[A-Za-z]{20}|github_pat_|glpat-|hf_[A-Za-z]{30}|sk-[A-Za-z]{20}|sk-(?:proj|ant)-|[sr]k_(?:live|test)_|AIza[\w-]{30}|eyJ"
    r"|xox[abprs]-[A-Za-z-]{10}|[a-f]{32}|[A-F]{32}"
)

#: Syllables of made-up names by script, and the endings that tell a gender.
SYLLABLES = {
    "latin": tuple("ba be bo da de do fa fe ga ka ke la le li lo ma me mi mo na ne no pa ra re ro sa se ta te to va ve vi".split()),
    "cyrillic": tuple("ба бе бо да де до ва ве га ка ко ла ле ли ло ма ме ми мо на не но па ра ре ро са се та те то".split()),
    "greek": tuple("βα βε γα δα δε δο κα κο λα λε λι λο μα με μι μο να νε νο πα ρα ρε ρο σα σε τα τε το".split()),
}
ENDINGS = {
    "latin": {"f": "lia", "m": "rin", "n": "nis", "s": "sted"},
    "cyrillic": {"f": "лия", "m": "рин", "n": "нис", "s": "сен"},
    "greek": {"f": "λια", "m": "ρος", "n": "νις", "s": "δης"},
}
#: The kinds of words of names: first names by gender, "n" behind a degree alone, and last names.
NAME_KINDS = ("given_f", "given_m", "given_n", "surname")
#: Kinds whose canonical form lacks the case of letters, and those whose canonical form lacks their separators.
_SEPARATED, _NUMBERS = ("email", "ipv6"), ("phone", "card", "iban", "ssn")
#: Draws per unit in its own format; from then on the format widens with each draw, so that some draw always is free.
NARROW_ROUNDS = 6
#: A secret with fewer letters and digits than this has its symbols drawn too.
FEW_DRAWN = 6


def _marked(text: Column) -> Column:
    """The text with a mark before every titled name; texts that hold a mark already are left alone."""
    marked = text
    for gender, mark in MARKS.items():
        titles = "|".join(TITLES[gender].split()) if gender in TITLES else _ALONE
        begins = rf"(?={_PARTICLES}{_NO_TITLE}\p{{Lu}}(?:[\p{{L}}\p{{M}}]|['’-]\p{{Lu}}|\. ?\p{{Lu}}))"
        marked = F.regexp_replace(marked, rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{titles})\.? {_STACKED}{begins}", f"$0{mark}")
    return F.when(text.rlike(f"[{_MARK}]"), text).otherwise(marked)


def _kind(entity: Column) -> Column:
    """The kind of a whole entity: the first pattern that fits it alone, else a secret told by what stands before it."""
    kind = F.lit(None).cast("string")
    for name in reversed([k for k in PATTERNS if k != "secret"]):
        kind = F.when(entity.rlike(rf"\A(?:{PATTERNS[name]})\z"), name).otherwise(kind)
    return F.coalesce(kind, F.lit("secret"))


def _units(text: Column) -> Column:
    """pos, part, kind, canon, surface and the text before it in its entity, of every unit of a text; a name gives one unit per word."""

    def of_entity(entity: Column, pos: Column) -> Column:
        def of_kind(kind: Column) -> Column:
            # Bound once: a lambda would cut the entity anew for each of its words.
            cut = F.struct(
                F.when(kind == "person", F.regexp_extract_all(entity, F.lit(NAME_WORD), 0)).otherwise(F.array(entity)).alias("words"),
                F.when(kind == "person", F.split(entity, NAME_WORD, -1)).otherwise(F.array(F.lit(""))).alias("between"),
            )
            gender = F.translate(F.substring(entity, 1, 1), _MARK, "".join(MARKS))

            def of_word(cut: Column, word: Column, part: Column) -> Column:
                n_words = F.size(cut["words"])
                role = F.when(kind != "person", kind).otherwise(
                    F.when((n_words > 1) & (part < n_words - 1), F.concat(F.lit("given_"), gender)).otherwise("surname")
                )
                canon = (
                    F.when(kind.isin("email", "person", "ipv6"), F.lower(word))
                    .when(kind.isin(*_NUMBERS), F.regexp_replace(word, "[^0-9A-Za-z]", ""))
                    .otherwise(word)
                )
                return F.struct(
                    pos.alias("pos"),
                    part.alias("part"),
                    role.alias("kind"),
                    canon.alias("canon"),
                    word.alias("surface"),
                    F.get(cut["between"], part).alias("before"),
                )

            return let(cut, lambda c: F.transform(c["words"], lambda word, part: of_word(c, word, part)))

        return let(_kind(entity), of_kind)

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(ENTITY), 0), of_entity))


def _draw(*what: Column) -> Column:
    """A number from the unit's digest and a place in it."""
    return F.xxhash64(F.col("_digest"), *what)


def _pick(letters: str | tuple[str, ...], *what: Column) -> Column:
    if isinstance(letters, str):
        return F.substring(F.lit(letters), (F.pmod(_draw(*what), F.lit(len(letters))) + 1).cast("int"), F.lit(1))
    return F.get(F.array(*map(F.lit, letters)), F.pmod(_draw(*what), F.lit(len(letters))).cast("int"))


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = "!#$%&*+-?^_~"
#: Letters beyond ASCII by script, in lower and upper case; those of other scripts become Latin.
_LETTERS = {
    r"\p{IsCyrillic}": ("абвгдежзиклмнопрстуфхцчшщэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ"),
    r"\p{IsGreek}": ("αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    r"\p{L}": (_LOWER, _UPPER),
}


#: Of known kinds of secrets.
_PREFIXES = "AKIA|gh[pousr]_|github_pat_|glpat-|hf_|sk-proj-|sk-ant-|sk-|[sr]k_live_|[sr]k_test_|xox[abprs]-|AIza|eyJ"


def _shape() -> Column:
    """What of ``canon`` stays (all before ``head`` and from ``tail`` on), and what its letters and symbols are.

    Kept: the last label of a mail domain, a phone's country code or leading zero, a card's first
    digit, a bank account's country, the prefix of a known kind of secret.
    """
    canon, kind = F.col("canon"), F.col("kind")
    head = (
        F.when(kind == "phone", F.greatest(F.col("code"), F.startswith(canon, F.lit("0")).cast("int")))
        .when(kind == "card", 1)
        .when(kind == "iban", 2)
        .when(kind == "secret", F.length(F.regexp_extract(canon, rf"\A(?:{_PREFIXES})?", 0)))
        .otherwise(0)
    )
    tail = F.when(kind == "email", F.length(F.regexp_extract(canon, r"\.[^.]*\z", 0))).otherwise(0)
    return F.struct(
        head.alias("head"),
        (F.length(canon) - tail).alias("tail"),
        ((kind == "secret") & canon.rlike(r"\A[0-9a-f]+\z")).alias("hex"),
        ((kind == "secret") & canon.rlike(r"\A[0-9A-F]+\z")).alias("upper_hex"),
        ((kind == "secret") & (F.length(F.regexp_replace(canon, r"[^\p{L}\p{N}]", "")) < FEW_DRAWN)).alias("symbols"),
    )


def _same_shape() -> Column:
    """A digit for each digit and a letter for each letter of ``canon``, by ``_shape``; separators stay.

    Letters are drawn in their script and case. Symbols are drawn where little else would be. After
    ``NARROW_ROUNDS`` draws each further one adds a character.
    """

    def beyond_ascii(c: Column, i: Column) -> Column:
        out = F.when(c.rlike(r"\p{N}"), _pick(_DIGITS, i))
        for script, (lower, upper) in _LETTERS.items():
            out = out.when(c.rlike(rf"(?=\p{{Lu}}){script}"), _pick(upper, i)).when(c.rlike(script), _pick(lower, i))
        # Marks and symbols such as emoji tell as much as letters do. An address has no symbols but marks.
        return out.when(F.col("kind") == "email", _pick(_LOWER, i)).otherwise(_pick(_SYMBOLS, i))

    def one(shape: Column, c: Column, i: Column) -> Column:
        return (
            F.when((i < shape["head"]) | (i >= shape["tail"]), c)
            .when(shape["hex"] | ((F.col("kind") == "ipv6") & (c != ":")), _pick("0123456789abcdef", i))
            .when(shape["upper_hex"], _pick("0123456789ABCDEF", i))
            .when(c.rlike("[0-9]"), _pick(_DIGITS, i))
            .when(c.rlike("[a-z]"), _pick(_LOWER, i))
            .when(c.rlike("[A-Z]"), _pick(_UPPER, i))
            .when(c.rlike(r"[^\x00-\x7F]"), beyond_ascii(c, i))
            .when(shape["symbols"], _pick(_SYMBOLS, i))
            .otherwise(c)
        )

    # The shape is bound once: a lambda would measure the whole of a long secret anew for each of its characters.
    drawn = let(_shape(), lambda shape: F.transform(F.split("canon", ""), lambda c, i: one(shape, c, i)))
    same = F.array_join(drawn, "")
    more = _more(F.when(F.col("kind") == "email", "a").otherwise("0"))
    return F.when(F.col("kind") == "email", F.concat(more, same)).otherwise(F.concat(same, more))


def _more(first: Column) -> Column:
    """Drawn characters, ten from ``first`` on: none in the first rounds, then one more for each."""
    n = F.greatest(F.col("attempt") - (NARROW_ROUNDS - 1), F.lit(0))
    return F.array_join(
        F.transform(F.slice(F.sequence(F.lit(0), n), 2, n), lambda i: F.char(F.ascii(first) + F.pmod(_draw(F.lit("more"), i), F.lit(10)))), ""
    )


def _octets() -> Column:
    """An address part with as many digits for each part; then any address, at last one with a part more than any has."""

    def one(octet: Column, i: Column) -> Column:
        pick = lambda low, n: (F.pmod(_draw(i), F.lit(n)) + low).cast("string")
        return (
            F.when(F.col("attempt") >= NARROW_ROUNDS, pick(0, 256))
            .when(F.length(octet) == 1, pick(1, 9))
            .when(F.length(octet) == 2, pick(10, 90))
            .otherwise(pick(100, 156))
        )

    address = F.array_join(F.transform(F.split("canon", r"\."), one), ".")
    return F.when(F.col("attempt") < 2 * NARROW_ROUNDS, address).otherwise(F.concat(address, F.lit("."), _more(F.lit("0"))))


def _luhn(digits: Column) -> Column:
    """Sum of a card number's digits, every second one from the right doubled."""
    last = F.length(digits) - 1

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when((last - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), one), F.lit(0), lambda total, x: total + x)


def _rest_97(account: Column) -> Column:
    """An account's number modulo 97, its first four characters moved to the end and letters read as 10 to 35."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def _name() -> Column:
    """Syllables in the script of ``canon``, ended as its kind says; more of them after each failed round."""
    canon, kind = F.col("canon"), F.col("kind")
    out = None
    for script, syllables in SYLLABLES.items():
        middle = F.array_join(
            F.transform(F.sequence(F.lit(0), F.lit(1) + (F.col("attempt") / 2).cast("int")), lambda i: _pick(syllables, i)), ""
        )
        end = (
            F.when(kind == "given_f", ENDINGS[script]["f"])
            .when(kind == "given_m", ENDINGS[script]["m"])
            .when(kind == "given_n", ENDINGS[script]["n"])
            .otherwise(ENDINGS[script]["s"])
        )
        found = F.concat(middle, end)
        block = {"latin": None, "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}[script]
        out = found if block is None else F.when(canon.rlike(block), found).otherwise(out)
    return out


def draw(units: DataFrame, key: str) -> DataFrame:
    """Add ``sur`` to (kind, canon, code, attempt): a surrogate from the keyed digest."""
    digest = F.sha2(F.concat_ws("\n", F.lit(key), "kind", "canon", F.col("attempt").cast("string")), 256)
    drawn = units.withColumn("_digest", digest).withColumn("_plain", _same_shape())
    names = F.col("kind").isin(*NAME_KINDS)
    # A valid card number gets a valid one: the last digit completes the sum.
    bare = F.expr("substring(_plain, 1, length(_plain) - 1)")
    valid_card = (F.col("kind") == "card") & (_luhn(F.col("canon")) % 10 == 0)
    check = F.pmod(10 - _luhn(F.concat(bare, F.lit("0"))) % 10, F.lit(10)).cast("string")
    # So does a valid bank account: its two check digits follow from the rest.
    country, account = F.expr("substring(_plain, 1, 2)"), F.expr("substring(_plain, 5, length(_plain))")
    valid_iban = (F.col("kind") == "iban") & (_rest_97(F.col("canon")) == 1)
    iban_check = F.lpad((98 - _rest_97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    sur = (
        F.when(names, _name())
        .when(F.col("kind") == "ip", _octets())
        .when(valid_card, F.concat(bare, check))
        .when(valid_iban, F.concat(country, iban_check, account))
        .otherwise(F.col("_plain"))
    )
    return drawn.withColumn("sur", sur).select("kind", "canon", "code", "attempt", "sur")


def assign(units: DataFrame, key: str) -> DataFrame:
    """(kind, canon, code, sur) with distinct surrogates none of which is a unit itself.

    Each round settles its table. A unit whose surrogate is taken, or shared with a smaller unit, draws again;
    after ``NARROW_ROUNDS`` rounds from a space that grows tenfold each time, so the rounds end.
    """
    units = settle(units.withColumn("attempt", F.lit(0)))
    originals = units.select("kind", F.col("canon").alias("sur")).distinct()
    accepted, open_units = None, units
    while True:
        drawn = settle(draw(open_units, key))
        first = drawn.groupBy("kind", "sur").agg(F.min("canon").alias("canon"))
        good = first.join(originals, ["kind", "sur"], "left_anti")
        if accepted is not None:
            good = good.join(accepted.select("kind", "sur"), ["kind", "sur"], "left_anti")
        good = settle(drawn.join(good, ["kind", "sur", "canon"], "left_semi"))
        accepted = good if accepted is None else accepted.unionByName(good)
        again = settle(
            drawn.join(good.select("kind", "canon"), ["kind", "canon"], "left_anti").drop("sur").withColumn("attempt", F.col("attempt") + 1)
        )
        if again.isEmpty():
            return accepted.drop("attempt")
        open_units = again


def _name_spelled(surface: Column, sur: Column) -> Column:
    """The surrogate of a word of a name in the case of ``surface``, or its initial."""
    return (
        F.when(F.length(surface) == 1, F.upper(F.substring(sur, 1, 1)))
        .when(F.upper(surface) == surface, F.upper(sur))
        .otherwise(F.initcap(sur))
    )


def _with_mentions(gap: Column, tables: Column) -> Column:
    """The pieces (text, found) of a text between entities, with surrogates for words that ``tables`` hold."""
    others = F.split(gap, MENTION, -1)

    def replaced(word: Column) -> Column:
        sur = let(F.lower(word), lambda w: F.get(tables, F.pmod(F.xxhash64(w), F.size(tables)).cast("int"))[w])
        return let(sur, lambda x: F.when(x.isNotNull(), _name_spelled(word, x)))

    def piece(other: Column, word: Column) -> Column:
        return let(replaced(word), lambda new: F.struct(F.concat(other, F.coalesce(new, word, F.lit(""))).alias("text"), new.isNotNull().alias("found")))

    # There is one word fewer than there are texts between words.
    return F.zip_with(others, F.regexp_extract_all(gap, F.lit(MENTION), 0), piece)


def _name_tables(names: Column) -> Column:
    """A text's (canon, kind, sur) as maps from canon to sur, about as many as each has entries: Spark searches a map from its start."""
    unique = lambda x: F.filter(x, lambda e, j: F.coalesce(F.get(x, j + 1)["canon"] != e["canon"], F.lit(True)))
    n = lambda x: F.ceil(F.sqrt(F.size(x))).cast("int")

    def table(entries: Column, k: Column) -> Column:
        fitting = F.filter(entries, lambda e: F.pmod(F.xxhash64(e["canon"]), n(entries)) == k)
        return F.map_from_entries(F.transform(fitting, lambda e: F.struct(e["canon"], e["sur"])))

    return let(let(F.sort_array(names), unique), lambda x: F.transform(F.sequence(F.lit(0), n(x) - 1), lambda k: table(x, k)))


#: What has a place of its own in a number or an address.
_SEPARATOR = r"[^\p{L}\p{M}\p{N}]"


def _spelled() -> Column:
    """The surrogate in the spelling of ``surface``: its separators and its case."""
    surface, sur = F.col("surface"), F.col("sur")
    names = F.col("kind").isin(*NAME_KINDS)
    name = _name_spelled(surface, sur)
    alnum = F.split(F.regexp_replace(sur, _SEPARATOR, ""), "")

    # Characters beyond the format's own stand behind a number, and before an address.
    more = F.size(alnum) - F.length(F.regexp_replace(surface, _SEPARATOR, ""))

    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), _SEPARATOR, ""))
        new = F.get(alnum, before)
        return F.when(c.rlike(_SEPARATOR), c).when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)

    overlaid = F.concat(
        F.array_join(F.transform(F.split(surface, ""), one), ""),
        F.array_join(F.slice(alnum, F.size(alnum) - more + 1, more), ""),
    )
    # Addresses keep their separators in canonical form, so places agree; these may be long, numbers are not.
    def cased(new: Column) -> Column:
        extra = F.size(new) - F.length(surface)

        def at(extra: Column) -> Column:
            def char(c: Column, i: Column) -> Column:
                x = F.get(new, i + extra)
                return F.when(c.rlike(_SEPARATOR), c).when(c.rlike(r"\p{Lu}"), F.upper(x)).otherwise(x)

            return F.concat(F.array_join(F.slice(new, 1, extra), ""), F.array_join(F.transform(F.split(surface, ""), char), ""))

        return let(extra, at)

    # The other kinds are replaced as they are.
    spelled = (
        F.when(F.col("kind").isin(*_SEPARATED), let(F.split(sur, ""), cased)).when(F.col("kind").isin(*_NUMBERS), overlaid).otherwise(sur)
    )
    return F.when(names, name).otherwise(spelled)


def _with_degrees(distinct: DataFrame, key: str) -> DataFrame:
    """(kind, canon, sur) of all units. A first name behind a degree alone shares the surrogate of the same name behind a title."""
    gendered = distinct.where(F.col("kind").isin("given_f", "given_m")).groupBy("canon").agg(F.min("kind").alias("kind"))
    twins = gendered.join(distinct.where("kind = 'given_n'").select("canon"), "canon", "left_semi")
    own = distinct.join(twins.select(F.lit("given_n").alias("kind"), "canon"), ["kind", "canon"], "left_anti")
    surrogates = assign(own, key).drop("code")
    shared = surrogates.join(twins, ["kind", "canon"], "left_semi").withColumn("kind", F.lit("given_n"))
    return surrogates.unionByName(shared)


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with entities replaced in ``text``, and n_entities and entity_kinds added.

    ``key`` decides all surrogates: the same key gives the same ones in every run, apart from those drawn again.
    """
    hinted = F.col(text).isNotNull() & F.col("_marked").rlike(HINT)
    prepared = docs.drop("n_entities", "entity_kinds").withColumn("_marked", _marked(F.col(text)))
    keyed = prepared.withColumn("_key", F.sha2(F.coalesce(text, F.lit("")), 256))
    units = settle(
        keyed.where(hinted)
        .select("_key", F.explode(_units(F.col("_marked"))).alias("_u"))
        .select("_key", "_u.*")
        .withColumn("code", F.when(F.col("kind") == "phone", F.length(F.regexp_extract("surface", r"\A\+(\d{1,3})(?=[ .(-])", 1))).otherwise(0))
        .distinct()
    )
    # Spellings of one number may show its country code or not; the most that any shows is kept.
    distinct = settle(units.groupBy("kind", "canon").agg(F.max("code").alias("code")))
    surrogates = _with_degrees(distinct, key)
    is_name = F.col("kind").isin(*NAME_KINDS)
    new = (
        units.join(surrogates, ["kind", "canon"])
        .withColumn("new", F.concat("before", _spelled()))
        .groupBy("_key")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "part", "new", "kind"))).alias("_new"),
            # An initial alone is no mention.
            F.collect_set(F.when(is_name & (F.length("canon") > 1), F.struct("canon", "kind", "sur"))).alias("_names"),
        )
    )
    # Written out, so that the join below reads two plain tables and Spark can split a text with very many copies.
    new = settle(new)
    gaps = F.split("_marked", ENTITY, -1)
    named = F.size("_names") > 0
    pieces = F.when(named, let(_name_tables(F.col("_names")), lambda tables: F.transform(gaps, lambda gap: _with_mentions(gap, tables))))
    mentions = F.aggregate("_pieces", F.lit(0), lambda total, x: total + F.size(F.filter(x, lambda piece: piece["found"])))
    joined = F.concat(
        F.array_join(
            F.transform(F.col("_new"), lambda u: F.concat(F.when(u["part"] == 0, F.get(F.col("_gaps"), u["pos"])).otherwise(""), u["new"])), ""
        ),
        F.get(F.col("_gaps"), F.size("_gaps") - 1),
    )
    unmarked = F.when(F.col(text).rlike(f"[{_MARK}]"), joined).otherwise(F.translate(joined, _MARK, ""))
    found = F.col("_new").isNotNull()
    return (
        keyed.join(new, "_key", "left")
        .withColumn("_pieces", pieces)
        .withColumn(
            "_gaps",
            F.when(F.col("_pieces").isNotNull(), F.transform("_pieces", lambda x: F.array_join(F.transform(x, lambda piece: piece["text"]), "")))
            .when(found, gaps),
        )
        .withColumns(
            {
                text: F.when(found, unmarked).otherwise(F.col(text)),
                "n_entities": (
                    F.coalesce(F.size(F.filter("_new", lambda u: u["part"] == 0)), F.lit(0)) + F.coalesce(mentions, F.lit(0))
                ).cast("bigint"),
                "entity_kinds": F.coalesce(F.array_sort(F.array_distinct(F.transform("_new", lambda u: u["kind"]))), F.array().cast("array<string>")),
            }
        )
        .drop("_marked", "_key", "_new", "_names", "_pieces", "_gaps")
    )
