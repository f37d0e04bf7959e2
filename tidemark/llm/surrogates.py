"""Personal data replaced by keyed surrogates of the same type and format; DataFrame functions only."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, store

#: Titles that tell a gender; fixed values.
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Mme", "Madame", "Mlle", "Sra", "Señora", "Doña", "Госпожа", "Κυρία"]
MALE = ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Sr", "Señor", "Don", "Господин", "Κύριος"]
NEUTRAL = ["Dr", "Prof"]

_END = r"(?![\p{L}\p{N}])"
_START = r"(?<![\p{L}\p{N}])"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
ADDRESS = r"(?<![\p{N}.])(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}(?!\.?\p{Nd})" + _END
CARD = r"(?<![\p{L}\p{N}])\p{Nd}{4}([ -]?)\p{Nd}{4}\1\p{Nd}{4}\1\p{Nd}{1,7}" + _END
SOCIAL = _START + r"\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}" + _END
ACCOUNT = _START + r"[A-Z]{2}\p{Nd}{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _END
#: Digits of a number after the country code where that is fixed.
NATIONAL = {8: "4[57]", 9: "3[1346]|4[18]|61|351|380", 10: "1|7|30|44|91", 11: "86"}
#: Between two digits of a phone; no space before a further address or price.
_GAP = r"\)?(?:[.-]| (?!(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}(?!\.?\p{Nd})|\p{Nd}+[.,]\p{Nd}{1,2}(?![.,]?\p{Nd})))?\(?"
#: After eight digits no space before a year either.
_LATE = _GAP.replace(r" (?!", r" (?!(?:19|20)\p{Nd}{2}(?!\p{Nd}|[ .-]\p{Nd})|", 1)
#: At most 15 digits unless the last group is longer: no group begins after the eleventh digit.
PHONE = (r"(?:(?<![\p{L}\p{N}+])\+(?:" + "|".join(rf"(?:{c})(?:{_GAP}\p{{Nd}}){{{n}}}" + _END for n, c in NATIONAL.items())
         + rf"|\p{{Nd}}(?:{_GAP}\p{{Nd}}){{2,7}}(?:{_LATE}\p{{Nd}}){{0,3}}\p{{Nd}}*+)"
         + r"|(?<![\p{L}\p{N}])\(?\p{Nd}{3}\)?[ .-]\p{Nd}{3}[ .-]\p{Nd}{4})" + _END)
TOKEN = _START + r"(?:[0-9a-fA-F]{40}|[0-9a-fA-F]{32}|[0-9a-fA-F]{64})" + _END
NAME = (_START + "(?:" + "|".join(sorted(FEMALE + MALE + NEUTRAL, key=len, reverse=True)) + r")\.? \p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?")

#: Types in the order in which a text is searched at one place.
TYPES = [("email", EMAIL), ("token", TOKEN), ("address", ADDRESS), ("card", CARD), ("social", SOCIAL), ("account", ACCOUNT),
         ("phone", PHONE), ("name", NAME)]
#: The group of the card pattern is the first one of the whole pattern.
ANY = "|".join(f"(?:{p})" for _, p in TYPES)
#: No entity without one of these.
HINT = r"[@\p{Nd}]|" + _START + "(?:" + "|".join(FEMALE + MALE + NEUTRAL) + r")\.? \p{Lu}"

VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αειου"}
CONSONANTS = {"latin": "bdfghklmnprstvz", "cyrillic": "бвгдзклмнпрстфх", "greek": "βγδζθκλμνπρστφχ"}
ENDINGS = {"latin": ("a", "o"), "cyrillic": ("а", "ов"), "greek": ("α", "ος")}
#: Letters that stand for letters of their script; all others are taken for Latin.
LATIN = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "Cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Armenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ",
    "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת", "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "Devanagari": "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह",
    "Thai": "กขคงจฉชซญดตถทธนบปผฝพฟภมยรลวสหอฮ", "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ", "Hangul": "가나다라마바사아자차카타파하",
    "Han": "一三山川水火木金土日月人大小中上下田石竹雨花犬馬鳥魚米王玉"}
#: Decimal digits of all scripts, ten by ten, 0-9 first.
DIGITS = "".join(chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd")
LITERAL_EXCEPTIONS = 5_000
#: Rounds in which colliding things draw anew, and the least number of values that those then left over draw for a format.
TURNS, DRAWS = 8, 2048


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _ascii(text: Column) -> Column:
    """Digits of every script as 0-9."""
    return F.when(text.rlike(r"[\p{Nd}&&[^0-9]]"), F.translate(text, DIGITS[10:], "0123456789" * (len(DIGITS) // 10 - 1))).otherwise(text)


def _digit(value: Column, like: Column) -> Column:
    """The digit of this value in the script of the digit ``like``."""
    place = F.greatest(F.instr(F.lit(DIGITS), like), F.lit(1)) - 1
    return F.substring(F.lit(DIGITS), place - place % 10 + value + 1, F.lit(1))


def _alphabet(c: Column) -> Column:
    letters = F.when(c.rlike("[A-Za-z]"), LATIN)
    for script, alphabet in ALPHABETS.items():
        letters = letters.when(c.rlike(rf"\p{{Is{script}}}"), alphabet)
    return letters.otherwise(LATIN)


def entity_type(entity: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed(TYPES[:-1]):
        kind = F.when(entity.rlike(rf"\A(?:{pattern})\z"), name).otherwise(kind)
    return kind


def canonical(kind: Column, entity: Column) -> Column:
    """What mentions of one thing have in common: lower case of addresses of mail and of tokens, digits of numbers (as 0-9), a name without its title."""
    digits = _ascii(F.regexp_replace(entity, r"[^\p{Nd}]", ""))
    plain = _ascii(F.regexp_replace(entity, r"[ .()-]", ""))
    return (F.when(kind.isin("email", "token"), F.lower(entity)).when(kind.isin("card", "social", "phone"), digits)
            .when(kind == "account", plain).when(kind == "name", F.regexp_replace(entity, r"\A\S+ ", ""))
            .when(kind == "address", _ascii(entity)).otherwise(entity))


def _stream(key: Column, seed: Column, size: Column) -> Column:
    """At least ``size`` hexadecimal bytes that depend on the key and the seed."""
    blocks = F.sequence(F.lit(0), F.floor(size / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda j: F.sha2(F.concat(key, F.sha2(F.concat(key, F.lit("|"), seed, F.lit("|"), j.cast("string")), 256)), 256)), "")


def _byte(stream: Column, at: Column) -> Column:
    return F.conv(F.substring(stream, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _alike(text: Column, stream: Column, hexadecimal: bool = False) -> Column:
    """``text`` with letters and digits replaced by others of their kind and script, taken in turn; marks stay.

    The n-th letter or digit takes the n-th byte, so two ways to write one number get one replacement.
    """
    both = F.lit("0123456789abcdef")
    upper = text.rlike(r"\p{Lu}") & ~text.rlike(r"\p{Ll}")

    def pick(letters: Column, n: int, value: Column) -> Column:
        return F.substring(letters, value % n + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        value = _byte(stream, F.length(F.regexp_replace(F.substring(text, F.lit(1), i), r"[^\p{L}\p{N}]", "")))
        if hexadecimal:
            return _let(pick(both, 16, value), lambda m: F.when(c.rlike(r"\p{Lu}") | (upper & ~c.rlike(r"\p{L}")), F.upper(m)).otherwise(m))
        letter = _let(_alphabet(c), lambda a: F.substring(a, value % F.length(a) + 1, F.lit(1)))
        return (F.when(c.rlike(r"\p{Nd}"), _digit(value % 10, c)).when(c.rlike(r"\p{Lu}"), F.upper(letter))
                .when(c.rlike(r"[\p{L}\p{N}]"), letter).otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn rule over a text of digits, the last one counting once."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")).otherwise(c.cast("int")))
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _card(entity: Column, stream: Column) -> Column:
    """Digits replaced; a number that satisfied the Luhn rule does so again by its last digit."""
    digits = _ascii(F.regexp_replace(entity, r"[^\p{Nd}]", ""))
    made = _alike(entity, stream)

    def last(m: Column) -> Column:
        body = F.substring(m, F.lit(1), F.length(m) - 1)
        zero = F.concat(_ascii(F.regexp_replace(body, r"[^\p{Nd}]", "")), F.lit("0"))
        return F.concat(body, _digit((10 - _luhn(zero) % 10) % 10, F.right(m, F.lit(1))))

    return F.when(_luhn(digits) % 10 == 0, _let(made, last)).otherwise(made)


def _mod97(text: Column) -> Column:
    """Remainder of the number that ``text`` gives with A-Z as 10 to 35."""
    values = F.transform(F.split(text, ""), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97)


def _valid_account(plain: Column) -> Column:
    return _mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1


def _account(entity: Column, longer: Column, stream: Column) -> Column:
    """The country stays; a number with right check digits has right ones again."""
    country = F.substring(entity, 1, 2)
    made = F.concat(country, _alike(F.substring(longer, F.lit(3), F.length(longer)), stream))

    def checked(m: Column) -> Column:
        rest = _ascii(F.regexp_replace(F.substring(m, F.lit(5), F.length(m)), " ", ""))
        return _let(98 - _mod97(F.concat(rest, country, F.lit("00"))), lambda n: F.concat(
            country, _digit(F.floor(n / 10).cast("int"), F.substring(entity, 3, 1)), _digit(n % 10, F.substring(entity, 4, 1)),
            F.substring(m, F.lit(5), F.length(m))))

    return F.when(_valid_account(_ascii(F.regexp_replace(entity, " ", ""))), _let(made, checked)).otherwise(made)


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _word(stream: Column, shift: Column, script: str, ending: Column) -> Column:
    """Four syllables and an ending; 75**4 different stems."""
    c, v = CONSONANTS[script], VOWELS[script]
    syllables = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.concat(
        F.substring(F.lit(c), _byte(stream, shift + i * 2) % len(c) + 1, F.lit(1)), F.substring(F.lit(v), _byte(stream, shift + i * 2 + 1) % len(v) + 1, F.lit(1))))
    return F.initcap(F.concat(F.array_join(syllables, ""), ending))


def _name(entity: Column, stream: Column) -> Column:
    """The title stays; each word of the name becomes one of its script, the first with an ending of the title's gender."""
    title = F.substring_index(entity, " ", 1)
    bare = F.regexp_replace(title, r"\.\z", "")
    words = F.split(F.regexp_replace(entity, r"\A\S+ ", ""), " ")

    def one(w: Column, i: Column) -> Column:
        made = None
        for script in ("latin", "cyrillic", "greek"):
            female, male = ENDINGS[script]
            ending = F.when(i > 0, "").when(bare.isin(FEMALE), female).when(bare.isin(MALE), male).otherwise("")
            value = _word(stream, i * 8, script, ending)
            made = F.when(_script(w) == script, value) if made is None else made.when(_script(w) == script, value)
        return F.when((F.upper(w) == w) & (F.length(w) > 1), F.upper(made)).otherwise(made)

    return F.concat(title, F.lit(" "), F.array_join(F.transform(words, one), " "))


def _seed(kind: Column, canon: Column, turn: Column) -> Column:
    return F.concat(kind, F.lit("|"), canon, F.lit("|"), turn.cast("string"))


def _longer(kind: Column, entity: Column, extra: Column) -> Column:
    """``entity`` with its last letter or digit (of a mail name before the @; of a name its last word) ``extra`` times more."""
    def more(text: Column) -> Column:
        last = F.right(text, F.lit(1))
        return F.concat(text, F.repeat(F.when(last.rlike(r"[\p{L}\p{N}]"), last).otherwise("a"), extra))

    name = F.concat(entity, F.repeat(F.concat(F.lit(" "), F.substring_index(entity, " ", -1)), extra))
    mail = F.concat(more(F.substring_index(entity, "@", 1)), F.lit("@"), F.substring_index(entity, "@", -1))
    return F.when(extra == 0, entity).when(kind == "name", name).when(kind == "email", mail).otherwise(more(entity))


def surrogate(kind: Column, entity: Column, key: Column, seed: Column, extra: Column) -> Column:
    """Replacement of ``entity`` drawn by ``seed``; longer by ``extra`` letters, digits or words where its format is full."""
    def make(text: Column) -> Column:
        return _let(_stream(key, seed, F.length(text) + 16 + extra * 8), lambda s: use(text, s))

    def use(text: Column, s: Column) -> Column:
        host = F.substring_index(entity, "@", -1)
        ending = F.substring_index(host, ".", -1)
        front = F.substring(host, F.lit(1), F.length(host) - F.length(ending) - 1)
        mail = F.concat(_alike(F.substring_index(text, "@", 1), s), F.lit("@"),
                        _let(_stream(key, F.concat(F.lit("host|"), F.lower(host)), F.length(host)), lambda h: _alike(front, h)), F.lit("."), ending)
        octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
            (_byte(s, i * 2) * 256 + _byte(s, i * 2 + 1)) % 254 + 1).cast("string")), ".")
        octets = F.when(extra == 0, octets).otherwise(F.concat(octets, _alike(F.repeat(F.lit("0"), extra), s)))
        first = F.substring(entity, 1, 1)
        octets = F.when(first.rlike("[0-9]"), octets).otherwise(F.array_join(F.transform(F.split(octets, ""), lambda c: F.when(
            c == ".", c).otherwise(_digit(c.try_cast("int"), first))), ""))
        return (F.when(kind == "email", mail).when(kind == "address", octets).when(kind == "card", _card(text, s))
                .when(kind == "token", _alike(text, s, True)).when(kind == "account", _account(entity, text, s))
                .when(kind == "name", _name(text, s)).otherwise(_alike(text, s)))

    return _let(_longer(kind, entity, extra), make)


def _marked(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__pattern``, by which its texts are searched, and ``__mentions`` as ``(mention, bare)``.

    A name found after a title is a mention wherever its text repeats it without one: ``mention`` is then the first
    one with a title, and ``bare`` is set.
    """
    def titled(m: Column) -> Column:
        return m.rlike(rf"\A(?:{NAME})\z")

    def name(m: Column) -> Column:
        return canonical(F.lit("name"), m)

    marked = docs.drop("n_entities").withColumn("__found", _found(F.col("text")))
    marked = marked.withColumn("__titled", F.filter("__found", titled))
    bare = F.array_sort(F.array_distinct(F.transform("__titled", name)), lambda a, b: F.length(b) - F.length(a))
    any_name = F.concat(F.lit("|" + r"(?<![\p{L}\p{N}]|\p{L}-)(?:"), F.array_join(bare, "|"), F.lit(")" + _END + r"(?!-\p{L})"))
    marked = marked.withColumn("__pattern", F.when(F.size("__titled") > 0, F.concat(F.lit(ANY), any_name)).otherwise(F.lit(ANY)))

    def mention(m: Column) -> Column:
        same = F.filter("__titled", lambda t: (name(t) == m) & ~titled(m))
        return F.struct(F.coalesce(F.get(same, F.lit(0)), m).alias("mention"), (F.size(same) > 0).alias("bare"))

    plain = F.transform("__found", lambda m: F.struct(m.alias("mention"), F.lit(False).alias("bare")))
    every = F.transform(F.regexp_extract_all("text", F.col("__pattern"), F.lit(0)), mention)
    return marked.withColumn("__mentions", F.when(F.size("__titled") > 0, every).otherwise(plain)).drop("__found", "__titled")


def _shown(made: Column, bare: Column) -> Column:
    """A surrogate as its mention was written: without a title where it had none."""
    return F.when(bare, F.regexp_replace(made, r"\A\S+ ", "")).otherwise(made)


def _found(text: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def colliding(entities: DataFrame, key: str, turns: int = TURNS, draws: int = DRAWS) -> DataFrame:
    """``entities(kind, canon, mention)``, one row per thing -> ``kind, canon, seed, extra`` of those that need another surrogate.

    Two things must not share a surrogate, and no surrogate may be a thing that occurs. Of things that collide the
    first keeps its surrogate; the rest are made anew with the next turn and checked against all again. Where things
    collide still after ``turns`` rounds their format is nearly full: those of one format then share out its free
    values (``_free_values``). What finds none, because the format is full, becomes longer, by one letter, digit
    or word more in every further round, until no collision is left.
    """
    spark = entities.sparkSession
    real = entities.select(F.col("kind").alias("rk"), F.col("canon").alias("rc"))
    fresh = entities.select("kind", "canon", "mention", F.lit(0).alias("turn"), F.lit(0).alias("extra"))
    state, path = store(_assigned(_seeded(fresh), key), "surrogates")
    step = 0
    while True:
        order = F.struct("turn", "canon")
        first = state.groupBy("kind", "made").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select(
            F.col("kind").alias("fk"), F.col("made").alias("fm"), "first")
        shared = state.join(first, (F.col("kind") == F.col("fk")) & (F.col("made") == F.col("fm"))).where(order > F.col("first")).select("kind", "canon")
        taken = state.join(real, (F.col("kind") == F.col("rk")) & (F.col("made") == F.col("rc")), "left_semi").select("kind", "canon")
        bad, bad_path = store(shared.union(taken).distinct(), "collisions")
        if bad.isEmpty():
            discard(spark, bad_path)
            break
        step += 1
        keep = state.join(bad, ["kind", "canon"], "left_anti")
        redo = state.join(bad, ["kind", "canon"], "left_semi").drop("made").withColumn("turn", F.col("turn") + 1)
        spent = []
        if step == turns + 1:
            redo, spent = _free_values(redo, keep, real, key, draws)
        elif step > turns:
            redo = _seeded(redo.withColumn("extra", F.col("extra") + 1))
        else:
            redo = _seeded(redo)
        after, after_path = store(keep.unionByName(_assigned(redo, key)), "surrogates")
        discard(spark, path, bad_path, *spent)
        state, path = after, after_path
    return state.where("turn > 0").select("kind", "canon", "seed", "extra")


def _seeded(things: DataFrame) -> DataFrame:
    return things.withColumn("seed", _seed(F.col("kind"), F.col("canon"), F.col("turn")))


def _assigned(things: DataFrame, key: str) -> DataFrame:
    return things.select("kind", "canon", "mention", "turn", "extra", "seed", _canonical_surrogate(key).alias("made"))


def _canonical_surrogate(key: str) -> Column:
    made = surrogate(F.col("kind"), F.col("mention"), F.lit(key), F.col("seed"), F.col("extra"))
    return _let(made, lambda m: canonical(F.col("kind"), m))


def _format(kind: Column, canon: Column, mention: Column) -> Column:
    """Equal only for things of which any seed makes one and the same surrogate."""
    def classes(text: Column) -> Column:
        for pattern, sign in [("[0-9]", "0"), ("[a-z]", "a"), ("[A-Z]", "A")] + [
                (rf"[\p{{Is{script}}}&&\p{{L}}&&[^\p{{Lu}}]]", alphabet[0]) for script, alphabet in ALPHABETS.items()]:
            text = F.regexp_replace(text, pattern, sign)
        return text

    mail = F.concat(classes(F.substring_index(canon, "@", 1)), F.lit("@"), F.substring_index(canon, "@", -1))
    account = F.concat(F.substring(canon, 1, 2), classes(F.substring(canon, F.lit(3), F.length(canon))), _valid_account(canon).cast("string"))
    card = F.concat(classes(canon), (_luhn(canon) % 10 == 0).cast("string"))
    return (F.when(kind == "email", mail).when(kind == "account", account).when(kind == "card", card)
            .when(kind == "name", mention).otherwise(classes(canon)))


def _numbered(rows: DataFrame, by: str, purpose: str) -> tuple[DataFrame, str]:
    """``rows`` with ``place``, from 1 within ``kind`` and ``format`` by ``by``; a format lies in as many tasks as it needs."""
    dealt, path = store(rows.repartitionByRange("kind", "format", by).withColumn("task", F.spark_partition_id()), purpose)
    group = ["kind", "format"]
    ahead = dealt.groupBy(*group, "task").agg(F.count("*").alias("n")).select(*group, "task", F.coalesce(F.sum("n").over(
        Window.partitionBy(*group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    at = F.row_number().over(Window.partitionBy(*group, "task").orderBy(by))
    return dealt.withColumn("at", at).join(ahead, [*group, "task"]).withColumn("place", F.col("at") + F.col("ahead")).drop("task", "at", "ahead"), path


def _free_values(left: DataFrame, keep: DataFrame, real: DataFrame, key: str, draws: int) -> tuple[DataFrame, list[str]]:
    """Seeds for the things ``left`` over, and scratch paths: the n-th of a format takes the n-th free value of that format.

    The things of a format draw 16 values each, and ``draws`` together at least, so a format that they nearly fill or
    that is small is drawn whole; values that are kept by others or occur are not free. Things beyond the free values
    become longer by one.
    """
    kind = F.col("kind")
    things, first = _numbered(left.withColumn("format", _format(kind, F.col("canon"), F.col("mention"))).drop("seed"), "canon", "colliding")
    sizes = things.groupBy("kind", "format").agg(F.count("*").alias("m"))
    each = F.ceil(F.greatest(F.lit(draws), 16 * F.col("m")) / F.col("m")).cast("int")
    drawn = things.join(sizes, ["kind", "format"]).withColumn("n", F.explode(F.sequence(F.lit(1), each))).repartition("kind", "canon", "n").withColumn(
        "seed", F.concat(kind, F.lit("|"), F.col("canon"), F.lit("|free|"), F.col("n").cast("string")))
    values = drawn.withColumn("made", _canonical_surrogate(key)).groupBy("kind", "made").agg(F.min(F.struct("format", "seed")).alias("v"))
    free = values.join(keep.select("kind", "made"), ["kind", "made"], "left_anti").join(
        real, (kind == F.col("rk")) & (F.col("made") == F.col("rc")), "left_anti").select("kind", "v.format", "v.seed")
    free, second = _numbered(free, "seed", "free-values")
    own = things.join(free, ["kind", "format", "place"], "left")
    full = F.col("seed").isNull()
    return own.select("kind", "canon", "mention", "turn", F.when(full, F.col("extra") + 1).otherwise(F.col("extra")).alias("extra"),
                      F.when(full, _seed(kind, F.col("canon"), F.col("turn"))).otherwise(F.col("seed")).alias("seed")), [first, second]


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """``docs(doc_id, text, ...)`` with personal data in ``text`` replaced, and ``n_entities``.

    Found are mail and network addresses, card, social-security, bank-account and phone numbers, access tokens in
    hexadecimal of either case, and names after a title, then also without one in the same text. Each gets a surrogate from a keyed hash: the same thing, however written,
    the same one in all documents (mail hosts keep together too); letters and digits by their kind, marks, length,
    right check digits of cards and accounts, script, letter case and the gender of the title stay. Surrogates are checked over the whole
    corpus: different things have different ones, and none is a thing that occurs; only where every value of a
    format is taken a surrogate is longer than its thing. Nulls stay null; texts
    without finds stay as they are; all other columns pass through, an own ``n_entities`` is replaced.
    The lookup of collided things is a literal while they are few, else a join by mention.
    """
    found = docs.select(F.explode(_found(F.col("text"))).alias("mention"))
    typed = found.select("mention", entity_type(F.col("mention")).alias("kind"))
    things = typed.select("mention", "kind", canonical(F.col("kind"), F.col("mention")).alias("canon")).groupBy("kind", "canon").agg(
        F.min("mention").alias("mention"))
    things, _ = store(things, "entities")
    again, _ = store(colliding(things, key), "exceptions")
    few = again.count()
    if few > LITERAL_EXCEPTIONS:
        return _by_join(docs, again, key)
    rows = again.collect()
    drawn = F.create_map(*[x for r in rows for x in (F.lit(f"{r['kind']}|{r['canon']}"), F.struct(
        F.lit(r["seed"]).alias("seed"), F.lit(r["extra"]).alias("extra")))]) if rows else None

    def replaced(s: Column) -> Column:
        m = s["mention"]

        def typed(k: Column) -> Column:
            def by(canon: Column) -> Column:
                usual = F.struct(_seed(k, canon, F.lit(0)).alias("seed"), F.lit(0).alias("extra"))
                if drawn is None:
                    return _let(usual["seed"], lambda seed: surrogate(k, m, F.lit(key), seed, F.lit(0)))
                return _let(F.coalesce(F.try_element_at(drawn, F.concat(k, F.lit("|"), canon)), usual),
                            lambda d: surrogate(k, m, F.lit(key), d["seed"], d["extra"]))

            return _shown(_let(canonical(k, m), by), s["bare"])
        return _let(entity_type(m), typed)

    return _rebuilt(_marked(docs), F.transform("__mentions", replaced))


def _rebuilt(marked: DataFrame, made: Column) -> DataFrame:
    """Texts put together from what lies between mentions and their replacements."""
    between = F.split("text", F.col("__pattern"), -1)
    text = F.array_join(F.flatten(F.zip_with(between, F.concat(made, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    has = F.coalesce(F.size("__mentions") > 0, F.lit(False))
    return marked.withColumn("n_entities", F.when(has, F.size("__mentions")).otherwise(0)).withColumn(
        "text", F.when(has, text).otherwise(F.col("text"))).drop("__mentions", "__pattern")


def _by_join(docs: DataFrame, again: DataFrame, key: str) -> DataFrame:
    """The same with the seeds joined by mention; mentions of a text are put back in order."""
    rows, _ = store(_marked(docs).withColumn("__row", F.monotonically_increasing_id()), "marked")
    each = rows.select("__row", F.posexplode("__mentions").alias("pos", "m")).select("__row", "pos", "m.mention", "m.bare").withColumn("kind", entity_type(F.col("mention")))
    each = each.withColumn("canon", canonical(F.col("kind"), F.col("mention"))).join(again, ["kind", "canon"], "left")
    kind, seed = F.col("kind"), F.coalesce("seed", _seed(F.col("kind"), F.col("canon"), F.lit(0)))
    made = _shown(surrogate(kind, F.col("mention"), F.lit(key), seed, F.coalesce("extra", F.lit(0))), F.col("bare"))
    made = each.select("__row", "pos", made.alias("made"))
    made = made.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("pos", "made"))).alias("__made"))
    joined = rows.join(made, "__row", "left").drop("__row")
    return _rebuilt(joined, F.col("__made.made")).drop("__made")
