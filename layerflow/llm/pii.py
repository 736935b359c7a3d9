"""Personal data: detected entities replaced by keyed surrogates of the same type and format.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerflow.llm.text import let
from layerflow.llm.training import release, stored

MALE = "Mr Mister Sir Herr Señor Sr Monsieur Господин г-н Κύριος".split()
FEMALE = "Mrs Ms Miss Madam Lady Frau Señora Señorita Sra Srta Madame Mademoiselle Mme Mlle".split()
FEMALE += "Госпожа г-жа Κυρία".split()
MALE += "Don mr".split()
FEMALE += "Doña mrs ms".split()
NEUTRAL = "Dr Doctor Prof Professor Rev Reverend Hon Mx Доктор Профессор dr prof rev mx".split()
# Of titles in capitals these: others are words, too, as in I MISS YOU
CAPITALS = "MR MRS MS DR PROF HERR FRAU".split()
TITLES = sorted(MALE + FEMALE + NEUTRAL + CAPITALS, key=len, reverse=True)
_PLAIN = "|".join(t for t in TITLES if t.lower() != "ms" or t == "Ms")
TITLE = rf"(?:(?<!\p{{N}} |\p{{N}})(?=ms|MS)(?:ms|MS)|{_PLAIN})"
# Titles may follow one another; Don is a given name there.
TITLES_AGAIN = rf"(?:(?!Don ){TITLE}\.? )*"

# Each pattern begins with a look at one letter, which is all that most positions cost.
_WORD = r"\p{Lu}(?:[\p{L}-]|['’](?!s(?!\p{L}))(?=\p{L}))*+"
_TITLED = rf"(?=[{''.join(sorted({t[0] for t in TITLES}))}])(?<!\p{{L}}){TITLE}\.? {TITLES_AGAIN}"
NAME = rf"{_TITLED}{_WORD}(?: {_WORD}){{0,2}}"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
HEX = (
    r"(?=[0-9A-Fa-f]{32})(?<![\p{L}\p{N}])(?=[A-Fa-f]*[0-9])"
    r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])"
)
_GIVEN = r"(?i:token|secret|password|api_key|apikey)\\?[\"']? {0,4}[=:]{0,2}"
_BARE = r"[^\s\"'<>,;&=]{4,}(?<![.!?:)])"
# What a key word is given: all that stands between quotation marks (escaped ones too), or else a
# bare word, which needs a digit unless it stands right behind the sign of equality.
ASSIGNED = (
    rf"(?<=\")(?<={_GIVEN}[=:]>? {{0,4}}\")(?:[^\"\\\r\n]|\\[^\r\n])++(?=\")"
    rf"|(?<=')(?<={_GIVEN}[=:]>? {{0,4}}')(?:[^'\\\r\n]|\\[^\r\n])++(?=')"
    rf"|(?<=\\[\"'])(?<={_GIVEN}[=:]>? {{0,4}}\\[\"'])[^\"'\\\r\n]++(?=\\[\"'])"
    rf"|(?<==)(?<={_GIVEN}=){_BARE}"
    rf"|(?<=[=:> \"'])(?<={_GIVEN}[=:]>? {{0,4}}\\?[\"']?)(?=[^\s\"'<>,;&=0-9]*+[0-9]){_BARE}"
)
IBAN = (
    r"(?=[A-Z]{2}\d{2})(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    r"(?![\p{L}\p{N}])"
)
# What follows the fixed beginnings of keys of two services.
TOKEN = (
    r"(?=[0-9A-Z])(?<=(?<![\p{L}\p{N}])A[KS]IA)[0-9A-Z]{16}(?![\p{L}\p{N}])"
    r"|(?=[0-9A-Za-z])(?<=(?<![\p{L}\p{N}])gh[pousr]_)[0-9A-Za-z]{36,}+(?![\p{L}\p{N}])"
)
# Eight groups, or fewer around "::" that are too many for a slice or a scope of a program.
IP6 = (
    r"(?=[0-9A-Fa-f]{1,4}:)(?<![\p{L}\p{N}:.])(?=[0-9A-Fa-f:]*+(?![\p{L}\p{N}:]))(?=[A-Fa-f:]*[0-9])"
    r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:(?:[0-9A-Fa-f]{1,4}:){2,6}|[Ff](?:[Ee]80|[CcDd][0-9A-Fa-f]{2}):)"
    r":(?:[0-9A-Fa-f]{1,4}:){0,5}[0-9A-Fa-f]{1,4})"
)
IP = r"(?=\d)(?<![\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\p{N})"
CARD = r"(?=\d{4})(?<!\p{N})(?:\d{4}(?:[ -]\d{4}){3}|\d{13,19})(?!\p{N})"
SSN = r"(?=\d{3}-)(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"
PHONE = (
    r"(?=[+(0-9])(?<![\p{N}+])(?:(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\d{3}[.-]\d{3}[.-]\d{4})(?!\p{N})"
)
ENTITY = "|".join([ASSIGNED, NAME, EMAIL, HEX, TOKEN, IBAN, IP6, IP, CARD, SSN, PHONE])
# Every entity but a name holds one of these, or stands between quotation marks or behind "=".
HINT = "[0-9@\"'=]"
NAME_HINT = rf"{_TITLED}\p{{Lu}}"

# Letters that stand in for letters of the same script, by position.
ALPHABETS = {
    r"[0-9]": "0123456789",
    r"[a-z]": "abcdefghijklmnopqrstuvwxyz",
    r"[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    r"[à-öø-ÿ]": "àáâãäåçèéêëìíîïñòóôõöùúûüý",
    r"[À-ÖØ-Þ]": "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝ",
    r"[а-яё]": "абвгдежзийклмнопрстуфхцчшщыэюя",
    r"[А-ЯЁ]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЫЭЮЯ",
    r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめも",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하고노도로모보소오조호구누두루무부수우주",
    r"\p{IsHan}": "山川田水木林森石金土日月星雲風雨雪花草竹梅松江河海湖春夏秋冬東西南北",
}
# Scripts by position above, or of too many signs to list
_LISTED = "GREEK HEBREW ARABIC HIRAGANA KATAKANA HENTAIGANA CJK HANGUL TANGUT KHITAN NUSHU".split()
_LISTED += "EGYPTIAN CUNEIFORM ANATOLIAN LINEAR BAMUM".split()


@lru_cache(maxsize=1)
def other_letters() -> list[str]:
    """Letters of all other scripts, in groups of one script and case (and style, as bold)."""
    groups: dict[tuple, list[str]] = {}
    for letter in map(chr, range(0x80, 0x20000)):
        kind, name = unicodedata.category(letter), unicodedata.name(letter, "").split(" ")
        if kind in ("Lu", "Ll", "Lo") and name[0] and name[0] not in _LISTED:
            style = name[: 2 if name[1:2] in (["SMALL"], ["LETTER"]) else 1]
            if name[0] == "MATHEMATICAL":
                style = (*name[:-1], len(name[-1]) == 1)
            other = letter.swapcase()  # keeps letters without one in the other case apart
            groups.setdefault((kind, *style, other != letter, len(other)), []).append(letter)
    return ["".join(letters) for letters in groups.values() if len(letters) > 1]


# (consonants, vowels, last letter of a woman's and of a man's given name)
SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v z".split(), "a e i o u".split(), "a", "nrsl"),
    "cyrillic": ("б в г д з к л м н п р с т".split(), "а е и о у".split(), "а", "нрсл"),
    "greek": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο ω".split(), "α", "ς"),
}
SCRIPT_OF = {"cyrillic": r"^[\p{IsCyrillic}'’-]+$", "greek": r"^[\p{IsGreek}'’-]+$"}
LATIN = r"^[\p{IsLatin}'’-]+$"
NAMES = ["given_f", "given_m", "given", "surname"]  # roles of a name's words
_SEP = "\u0001"


def _titles_of(mention: Column) -> Column:
    """The titles that a name begins with, and the space after them."""
    return F.regexp_extract(mention, rf"^{TITLE}\.? {TITLES_AGAIN}", 0)


def parts_of(mention: Column) -> Column:
    """The entities in a mention, in order: an array of ``kind, canonical, raw, role``.

    Forms of one entity share a canonical value: case of addresses and tokens, punctuation of
    numbers, the country's and the trunk's digits before a phone number, case of names. A name
    gives one entity per word, whatever place the word has in it; its role here is surname for
    the last word, and else a given name with the gender of the title, if it has one. An address
    gives itself and its domain.
    """

    def part(kind, canonical, raw, role=None):
        return F.struct(
            F.lit(kind).alias("kind"),
            canonical.alias("canonical"),
            raw.alias("raw"),
            (F.lit(None).cast("string") if role is None else role).alias("role"),
        )

    digits = F.regexp_replace(mention, "[^0-9]", "")
    domain = F.substring_index(mention, "@", -1)
    titles = F.split(F.lower(_titles_of(mention)), r"\.? ")
    words = F.split(F.substr(mention, F.length(_titles_of(mention)) + 1), " ")
    given = (
        F.when(F.arrays_overlap(titles, _lower(FEMALE)), "given_f")
        .when(F.arrays_overlap(titles, _lower(MALE)), "given_m")
        .otherwise("given")
    )
    return (
        F.when(
            mention.rlike(f"^(?:{EMAIL})$"),
            F.array(
                part("email", F.lower(mention), F.substring_index(mention, "@", 1)),
                part("domain", F.lower(domain), domain),
            ),
        )
        .when(
            mention.rlike(f"^(?:{NAME})$"),
            F.transform(
                words,
                lambda word, i: part(
                    "name",
                    F.lower(word),
                    word,
                    F.when(i < F.size(words) - 1, given).otherwise("surname"),
                ),
            ),
        )
        .when(mention.rlike(r"^(\d{1,3}\.){3}\d{1,3}$"), F.array(part("ip", mention, mention)))
        .when(
            mention.rlike(r"^[0-9A-Fa-f:]+:[0-9A-Fa-f:]*:[0-9A-Fa-f]+$"),
            F.array(part("ip6", F.lower(mention), mention)),
        )
        .when(
            mention.rlike(r"^([0-9a-f]{32,}|[0-9A-F]{32,})$"),
            F.array(part("secret", F.lower(mention), mention)),
        )
        .when(
            mention.rlike(f"^(?:{IBAN})$"),
            F.array(part("iban", F.replace(mention, F.lit(" "), F.lit("")), mention)),
        )
        .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.array(part("ssn", digits, mention)))
        .when(
            mention.rlike(f"^(?:{CARD})$"),
            F.array(part("card", digits, mention)),
        )
        .when(
            mention.rlike(f"^(?:{PHONE})$"),
            F.array(part("phone", _national(mention, digits), mention)),
        )
        .otherwise(F.array(part("secret", mention, mention)))
    )


def _lower(titles) -> Column:
    return F.array(*map(F.lit, sorted({t.lower() for t in titles})))


def _national(mention: Column, digits: Column) -> Column:
    """A phone number's digits without those of the country and without zeros before."""
    code = (
        F.when(~mention.startswith("+"), 0)
        .when(mention.rlike(r"^\+[17]"), 1)
        .when(mention.rlike(r"^\+\d{1,3}[^\d]"), F.length(F.regexp_extract(mention, r"^\+(\d+)", 1)))
        .otherwise(2)
    )
    rest = F.regexp_replace(F.substr(digits, code + 1), "^0+", "")
    return F.when(rest == "", digits).otherwise(rest)


def _byte(stream: Column, i: Column) -> Column:
    """The ``i``-th byte of a stream of blocks of 32."""
    block, at = F.get(stream, F.shiftright(i, 5)), F.pmod(i, F.lit(32))
    return F.conv(F.substr(block, 2 * at + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters, n: Column) -> Column:
    """The ``n``-th letter, counting on from the first after the last."""
    letters = "".join(letters)
    return F.substr(F.lit(letters), F.pmod(n, F.lit(len(letters))).cast("int") + 1, F.lit(1))


def _each(text: Column, fn) -> Column:
    """``fn(letter, position from 0)`` over the letters of ``text``, joined."""
    return F.array_join(F.transform(F.split(text, ""), fn), "")


def _same_class(text: Column, stream: Column) -> Column:
    """Each letter or digit replaced by one of its own class; anything else stays."""

    groups = F.array(*map(F.lit, other_letters()))

    def other(letter, byte):
        group = F.get(F.filter(groups, lambda g: F.contains(g, letter)), F.lit(0))
        made = let(group, lambda g: F.substr(g, F.pmod(byte, F.length(g)) + 1, F.lit(1)))
        return F.coalesce(made, letter)

    def swap(letter, i):
        byte = _byte(stream, i)
        cases = [(F.regexp_like(letter, F.lit(c)), _pick(a, byte)) for c, a in ALPHABETS.items()]
        cases.append((F.regexp_like(letter, F.lit(r"\p{L}")), other(letter, byte)))
        return reduce(lambda rest, case: F.when(*case).otherwise(rest), reversed(cases), letter)

    return _each(text, swap)


def _longer(text: Column, stream: Column, attempt: Column) -> Column:
    """Letters to add once the values of a length have proved too few, as for one-letter names."""
    at = F.sequence(F.lit(8), attempt)
    more = F.transform(
        at, lambda i: _pick(ALPHABETS["[a-z]"], _byte(stream, F.length(text) + F.pmod(i, F.lit(32))))
    )
    return F.when(attempt >= 8, F.array_join(more, "")).otherwise("")


def _more_digits(stream: Column, attempt: Column) -> Column:
    """Digits to add once the numbers of a length have proved too few."""
    at = F.sequence(F.lit(20), attempt)
    more = F.transform(at, lambda i: _pick("0123456789", _byte(stream, F.pmod(i, F.lit(32)))))
    return F.when(attempt >= 20, F.array_join(more, "")).otherwise("")


def _digit_sum(digits: Column) -> Column:
    """Sum modulo 10 of the card checksum over all digits but the last, still missing one."""
    n = F.length(digits)
    at = F.sequence(F.lit(0), n - 1)

    def weigh(total, i):
        digit = F.substr(digits, i + 1, F.lit(1)).cast("int")
        doubled = 2 * digit - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(F.pmod(n - i, F.lit(2)) == 1, doubled).otherwise(digit)

    return F.pmod(F.aggregate(at, F.lit(0), weigh), F.lit(10))


def _card(digits: Column, stream: Column, more: Column) -> Column:
    """Keeps the network digit, and whether the checksum holds."""
    n = F.length(digits)
    body = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        _each(F.substr(digits, F.lit(2), n - 2), lambda _, i: _pick("0123456789", _byte(stream, i))),
        more,
    )
    valid = F.pmod(
        _digit_sum(F.substr(digits, F.lit(1), n - 1)) + F.substr(digits, n, F.lit(1)).cast("int"),
        F.lit(10),
    ) == 0
    check = F.pmod(10 - _digit_sum(body), F.lit(10))
    broken = F.pmod(check + 1 + F.pmod(_byte(stream, n), F.lit(9)), F.lit(10))
    return F.concat(body, F.when(valid, check).otherwise(broken).cast("string"))


def _mod97(text: Column) -> Column:
    """Remainder of an account number, its letters read as 10 to 35."""

    def step(rest, i):
        code = F.ascii(F.substr(text, i, F.lit(1)))
        digit = F.when(code < 58, code - 48).otherwise(code - 55)
        return F.pmod(rest * F.when(digit > 9, 100).otherwise(10) + digit, F.lit(97)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)


def _iban(value: Column, account: Column) -> Column:
    """Keeps the country; the check digits hold."""
    country = F.substr(value, F.lit(1), F.lit(2))
    check = 98 - _mod97(F.concat(account, country, F.lit("00")))
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)


def _number(value: Column, stream: Column, more: Column) -> Column:
    """Digits of which the first is 2 to 9."""
    made = _each(
        value,
        lambda _, i: F.when(i == 0, _pick("23456789", _byte(stream, i))).otherwise(
            _pick("0123456789", _byte(stream, i))
        ),
    )
    return F.concat(made, more)


def _ip(value: Column, stream: Column, attempt: Column) -> Column:
    """Octets of as many digits; of any number once that space has proved too full."""

    def octet(part, i):
        byte = _byte(stream, i)
        digits = F.when(attempt >= 8, 3 - F.pmod(byte, F.lit(3))).otherwise(F.length(part))
        number = (
            F.when(digits == 1, 1 + F.pmod(byte, F.lit(9)))
            .when(digits == 2, 10 + F.pmod(byte, F.lit(90)))
            .otherwise(100 + F.pmod(byte, F.lit(155)))
        )
        return number.cast("string")

    return F.array_join(F.transform(F.split(value, r"\."), octet), ".")


def _has_syllables(value: Column) -> Column:
    scripts = [LATIN, *SCRIPT_OF.values()]
    return reduce(lambda a, b: a | b, (value.rlike(script) for script in scripts))


def _name(role: Column, value: Column, stream: Column, attempt: Column, other: Column) -> Column:
    """Syllables of the same script; a given name's last letter follows the gender.

    Other scripts than Latin, Cyrillic and Greek: ``other``.
    """

    def made(script):
        consonants, vowels, female, male = SYLLABLES[script]
        n = 2 + F.floor(attempt / 4).cast("int")
        syllables = F.array_join(
            F.transform(
                F.sequence(F.lit(0), n),
                lambda i: F.concat(
                    _pick(consonants, _byte(stream, 2 * i)), _pick(vowels, _byte(stream, 2 * i + 1))
                ),
            ),
            "",
        )
        last = (
            F.when(role == "given_f", F.lit(female))
            .when(role == "given_m", _pick(male, _byte(stream, F.lit(30))))
            .otherwise(_pick(consonants, _byte(stream, F.lit(31))))
        )
        # a surname that ends in a vowel, as women's surnames of some languages do, still does
        vowel = F.regexp_like(value, F.lit(f"[{''.join(vowels)}]$"))
        return F.concat(
            F.when(role == "given_f", F.regexp_replace(syllables, ".$", "")).otherwise(syllables),
            F.when((role == "surname") & vowel, F.lit("")).otherwise(last),
        )

    return (
        F.when(value.rlike(LATIN), made("latin"))
        .when(value.rlike(SCRIPT_OF["cyrillic"]), made("cyrillic"))
        .when(value.rlike(SCRIPT_OF["greek"]), made("greek"))
        .otherwise(other)
    )


def surrogate(kind: Column, value: Column, role: Column, attempt: Column, key: str) -> Column:
    """The replacement of a canonical value; a keyed function of it, its role and the attempt."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(value) / 32).cast("int") + 1)
    # a long value goes into each block by its own hash, or the work would grow with its square
    tag = F.when(F.length(value) > 256, F.sha2(value, 256)).otherwise(value)

    def stream(tag):
        return F.transform(
            blocks, lambda b: F.sha2(F.concat_ws(_SEP, F.lit(key), kind, tag, attempt, b), 256)
        )

    return let(let(tag, stream), lambda stream: _made(kind, value, role, attempt, stream))


def _made(kind: Column, value: Column, role: Column, attempt: Column, stream: Column) -> Column:
    local = F.substring_index(value, "@", 1)
    domain = F.substring_index(value, "@", -1)
    suffix = F.concat(F.lit("."), F.substring_index(value, ".", -1))
    is_hex = value.rlike("^[0-9a-f]+$")
    hexed = _each(
        value,
        lambda c, i: F.when(F.regexp_like(c, F.lit("[0-9]")), _pick("0123456789", _byte(stream, i)))
        .when(F.regexp_like(c, F.lit("[a-f]")), _pick("abcdef", _byte(stream, i)))
        .otherwise(c),
    )
    host = F.substr(value, F.lit(1), F.length(value) - F.length(suffix))
    longer, more = _longer(value, stream, attempt), _more_digits(stream, attempt)
    # what is replaced letter by letter, in one place: the table of letters is large
    subject = (
        F.when(kind == "email", local)
        .when(kind == "domain", host)
        .when(kind == "iban", F.substr(value, F.lit(5)))
        .when((kind == "secret") & ~is_hex, value)
        .when((kind == "name") & ~_has_syllables(value), value)
        .otherwise("")
    )
    return let(
        _same_class(subject, stream),
        lambda same: F.when(kind == "email", F.concat(same, longer, F.lit("@"), domain))
        .when(kind == "domain", F.concat(same, longer, suffix))
        .when(kind == "ip", _ip(value, stream, attempt))
        .when(kind == "ip6", hexed)
        .when(kind == "card", _card(value, stream, more))
        .when(kind == "iban", _iban(value, F.concat(same, more)))
        .when(kind.isin("ssn", "phone"), _number(value, stream, more))
        .when(kind == "name", _name(role, value, stream, attempt, F.concat(same, longer)))
        .when(is_hex, F.concat(hexed, longer))
        .otherwise(F.concat(same, longer)),
    )


def surrogates(entities: DataFrame, key: str, max_attempts: int = 40) -> DataFrame:
    """``kind, canonical, role, attempt, surrogate`` for distinct ``kind, canonical`` with a ``role``.

    No two entities of a kind share a surrogate, and no surrogate is a real value of its kind.
    An entity that would break this takes its next attempt; those settled earlier stay.
    """
    kind, value, attempt = F.col("kind"), F.col("canonical"), F.col("attempt")
    made = surrogate(kind, value, F.col("role"), attempt, key)
    table = stored(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", made), "pii")
    order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "canonical")
    real = entities.select("kind", F.col("canonical").alias("surrogate"))
    for _ in range(max_attempts):
        same = table.withColumn("n", F.row_number().over(order)).where("n > 1").drop("n")
        losers = same.union(table.join(real, ["kind", "surrogate"], "left_semi").select(same.columns))
        losers = stored(losers.select("kind", "canonical").distinct(), "pii-again")
        if losers.isEmpty():
            release(losers)
            return table
        moved = table.join(losers.withColumn("lost", F.lit(True)), ["kind", "canonical"], "left")
        moved = moved.select(
            "kind", "canonical", "role", (attempt + F.when(F.col("lost"), 1).otherwise(0)).alias("attempt")
        )
        before, table = table, stored(moved.withColumn("surrogate", made), "pii")
        release(before, losers)
    raise RuntimeError(f"surrogates still collide after {max_attempts} attempts")


def _rendered(kind: Column, raw: Column, made: Column) -> Column:
    """A surrogate in the form of the mention: its punctuation, or its upper and lower case."""
    def filled(made):
        """Digits and letters from the right; those before them, as a country's code, stay."""
        here = F.length(F.regexp_replace(raw, "[^0-9A-Za-z]", ""))
        stay = F.greatest(here - F.length(made), F.lit(0))

        def fill(letter, i):
            before = F.regexp_replace(F.substr(raw, F.lit(1), i + 1), "[^0-9A-Za-z]", "")
            place = F.length(before) - stay
            return F.when(
                F.regexp_like(letter, F.lit("[0-9A-Za-z]")) & (place > 0),
                F.substr(made, place, F.lit(1)),
            ).otherwise(letter)

        return F.concat(_each(raw, fill), F.substr(made, here + 1))

    cased = let(
        F.split(made, ""),
        lambda letters: _each(
            raw,
            lambda letter, i: F.when(
                letter != F.lower(letter), F.upper(F.get(letters, i))
            ).otherwise(F.get(letters, i)),
        ),
    )
    # a surrogate may be longer than what it stands for
    cased = F.concat(cased, F.substr(made, F.length(raw) + 1))
    name = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(made)).otherwise(
        F.initcap(made)
    )
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), filled(made))
        .when(kind == "ip", made)
        .when(kind == "name", name)
        .otherwise(cased)
    )


def _key_of(part: Column) -> Column:
    return F.concat_ws(_SEP, part["kind"], part["canonical"], part["raw"])


def has_entity(text: Column) -> Column:
    """Is there any mention? Two cheap looks spare most texts the full pattern; null gives false."""
    hint = text.rlike(HINT) | text.rlike(NAME_HINT)
    return F.coalesce(hint & text.rlike(ENTITY), F.lit(False))


def _text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def mentions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``text_key, kind, canonical, raw, role`` of the entities in each distinct text."""
    text = F.col(text_col)
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    # a filter and no generator first, so that texts without entities are hashed by nobody
    some = docs.where(has_entity(text)).select(_text_key(text).alias("text_key"), found.alias("m"))
    each = some.select("text_key", F.explode("m").alias("m"))
    return each.select("text_key", F.explode(parts_of(F.col("m"))).alias("part")).select(
        "text_key", "part.*"
    )


def entities_of(found: DataFrame) -> DataFrame:
    """``kind, canonical, role`` of distinct entities in the rows of ``mentions``.

    A name has one role in the whole corpus: given with the gender that more texts give it
    (none if as many give the other), given, or surname if it is never a given name.
    """
    count = {r: F.count_if(F.col("role") == r) for r in NAMES}
    role = (
        F.when(count["given_f"] > count["given_m"], "given_f")
        .when(count["given_m"] > count["given_f"], "given_m")
        .when(count["given"] + count["given_m"] > 0, "given")
        .when(count["surname"] > 0, "surname")
    )
    return found.groupBy("kind", "canonical").agg(role.alias("role"))


def replace_entities(
    docs: DataFrame, key: str, *, text_col: str = "text", count_col: str | None = None
) -> DataFrame:
    """``docs`` with every detected entity replaced in its whole texts; other columns stay.

    Addresses, domains, numbers of phones, cards, accounts and machines, tokens, and names after
    a title are replaced by values that are a function of ``key`` and the entity, so one entity
    is the same everywhere, in all its forms, and different ones stay different. A name that a
    text introduces with a title is also replaced where it stands alone in that text; each of its
    words is one entity, be it given name or surname, with or without a title of either gender, and
    takes the form that most of its titles ask for. A phone number is the same with and without
    its country. Formats are kept: punctuation, case, script, digits per octet, country, checksum,
    gender, until a format has too few values for all entities: then they grow longer. Titles are
    read as listed; a name that nothing introduces is not found. Null and empty texts, and texts without entities, stay as they are; repeated rows are treated alike.
    ``count_col`` adds the number of mentions.

    Tokens are hexadecimal runs from 32 digits on, what follows the fixed beginnings of two services'
    keys, and what stands behind token, secret, password
    or api key and ``=`` or ``:``: all that is between quotation marks, or a bare word of 4 letters
    or more, with a digit unless it follows ``=`` at once. None is too long.
    """
    names = ("__lf_key", "__lf_map", "__lf_found")
    if clash := {*names, count_col} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are there already")
    text = F.col(text_col)
    # one row per distinct text and part; copies of a text give the same rows
    found = stored(mentions(docs, text_col).distinct(), "pii-mentions")
    table = surrogates(entities_of(found), key)
    made = F.when(
        F.col("kind") == "email", F.substring_index("surrogate", "@", 1)
    ).otherwise(F.col("surrogate"))
    entry = F.struct(
        F.concat_ws(_SEP, "kind", "canonical", "raw").alias("key"),
        _rendered(F.col("kind"), F.col("raw"), made).alias("value"),
    )
    maps = (
        found.join(table, ["kind", "canonical"])
        .select("text_key", entry.alias("entry"))
        .groupBy("text_key")
        .agg(F.map_from_entries(F.sort_array(F.collect_set("entry"))).alias(names[1]))
        .withColumnRenamed("text_key", names[0])
    )
    has = has_entity(text)
    some = docs.where(has).withColumn(names[0], _text_key(text)).join(maps, names[0], "left")
    some = some.withColumn(names[2], F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    new = _rebuilt(text, F.col(names[2]), F.col(names[1]))
    columns = [new.alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    rest = docs.where(~has)
    if count_col is None:
        return some.select(*columns).union(rest)
    counted = F.size(names[2]).cast("long").alias(count_col)
    return some.select(*columns, counted).union(
        rest.select("*", F.lit(0).cast("long").alias(count_col))
    )


def _rebuilt(text: Column, found: Column, known: Column) -> Column:
    """The text's pieces between mentions, and the mentions' surrogates, put together again."""

    def shown(mention):
        parts = parts_of(mention)
        values = F.transform(parts, lambda p: F.coalesce(known[_key_of(p)], p["raw"]))
        kind = parts[0]["kind"]
        return (
            F.when(kind == "email", F.array_join(values, "@"))
            .when(
                kind == "name",
                F.concat(_titles_of(mention), F.array_join(values, " ")),
            )
            .otherwise(values[0])
        )

    pieces = F.split(text, ENTITY, -1)
    filled = F.array_append(F.transform(found, shown), F.lit(""))
    whole = F.array_join(F.zip_with(pieces, filled, lambda a, b: F.concat(a, b)), "")
    # names that the text has introduced, where they stand alone
    introduced = F.filter(
        F.map_entries(known), lambda e: F.startswith(e["key"], F.lit(f"name{_SEP}"))
    )

    def alone(so_far, entry):
        word = F.substring_index(entry["key"], _SEP, -1)
        pattern = F.concat(
            F.lit(r"(?<![\p{L}\p{N}@.-])\Q"), word, F.lit(r"\E(?![\p{L}\p{N}@])")
        )
        return F.regexp_replace(so_far, pattern, entry["value"])

    return F.when(F.size(introduced) > 0, F.aggregate(introduced, whole, alone)).otherwise(whole)
