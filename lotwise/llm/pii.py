"""Surrogates for personal data: keyed, of the same type, format, script and gender, and distinct.

Entities are found per text and brought to a normal form. Each distinct form of the corpus gets one
surrogate from a keyed hash, so all mentions of it, in any text and format, agree. A name is found after a
title, and by its capitalised words in the rest of the same text. A check over the corpus
finds forms that would share a surrogate, or get one that is itself a real form; they are hashed again
until all surrogates differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.rows import of, packed, unpacked
from lotwise.llm.secrets import located
from lotwise.sources.scratch import materialize

EMAIL = r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}(?![A-Za-z0-9])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9A-Za-z])"
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
CARD = r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
PHONE = (r"(?<![\w.+-])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])"
         r"|(?<![\w.+-])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![\w-])"
         r"|(?<![\w.+-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])")
_NAME_WORD = r"\p{Lu}[\p{L}'’-]+"
TITLES = {"m": "Mr|Sir|Herr|Monsieur|Señor|Sr|г-н|господин|Κύριος", "f": "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Señora|Sra|г-жа|госпожа|Κυρία",
          "x": "Dr|Prof"}
NAME = rf"(?<!\w)(?:{'|'.join(TITLES.values())})\.? {_NAME_WORD}(?: {_NAME_WORD}){{0,2}}"
#: What may follow a name without being a part of it.
NAME_END = r"(?:['’][sS])?['’-]*$"
KINDS = {"email": EMAIL, "ip": IP, "ssn": SSN, "card": CARD, "iban": IBAN, "phone": PHONE, "name": NAME}
#: What every entity has: a digit beside a digit or a sign, an @, or a title.
HINT = rf"@|[0-9][0-9.() -]|(?:{'|'.join(TITLES.values())})\.? \p{{Lu}}"

# ---- fixed values: given and family names by script and gender, syllables for further ones ----
GIVEN = {
    "latin_m": "Adam Bruno Carl David Erik Felix Henry Ivan James Karl Leo Martin Noah Oscar Paul Robert Simon Thomas Victor Walter",
    "latin_f": "Alice Bella Clara Diana Emma Flora Greta Helen Irene Julia Karen Laura Maria Nora Olivia Paula Rosa Sarah Teresa Vera",
    "cyrillic_m": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Сергей Тимур",
    "cyrillic_f": "Алиса Белла Вера Галина Дарья Елена Жанна Зоя Инна Клара Лидия Мария Нина Ольга Полина Раиса",
    "greek_m": "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Ιωάννης Κώστας Λουκάς Μάρκος Νίκος Πέτρος",
    "greek_f": "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ηρώ Ιωάννα Κατερίνα Μαρία Νίκη Σοφία",
}
FAMILY = {
    "latin": "Archer Barker Conway Dalton Ellis Fowler Graham Harper Irwin Jensen Keller Lawson Mercer Norton Osborn Porter Quinn Reeves Sutton Turner",
    "cyrillic": "Абрамов Баранов Волков Горин Дроздов Ершов Журавлев Зимин Котов Лебедев Морозов Новиков Орлов Панов Рыбаков Соколов",
    "greek": "Αλεξίου Βλάχος Γεωργίου Δήμου Ηλιάδης Θεοδώρου Ιωάννου Καραγιάννης Λάμπρου Μακρής Νικολάου Παππάς",
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi wa we wi",
    "cyrillic": "ба бе би бо ва ве ви во да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то",
    "greek": "βα βε βι βο γα γε γι γο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το",
}
MAX_TRIES = 64


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Checksum of a card number; every second digit from the right but one counts twice."""
    each = F.split(F.reverse(digits), "")
    value = F.transform(each, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0)))


def _kind(value: Column) -> Column:
    out = None
    for kind, pattern in KINDS.items():
        test = value.rlike(f"^(?:{pattern})$")
        if kind == "card":  # without a right checksum it is some other account number
            right = F.when(luhn_sum(_digits(value)) % 10 == 0, "card").otherwise("account")
            out = out.when(test, right)
            continue
        out = F.when(test, F.lit(kind)) if out is None else out.when(test, F.lit(kind))
    return out


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^[Ͱ-Ͽἀ-῿]"), "greek").when(word.rlike(r"^[Ѐ-ԯ]"), "cyrillic").otherwise("latin")


def entities(text: Column) -> Column:
    """Array of (kind, start, end, value) in code points; of a name each word after the title is one.

    Leftmost first, and as long as the patterns have it. Kinds of name
    words say which they are and whose: ``given_m``, ``given_f``, ``given_x`` or ``family``.
    Capitalised words equal to one of them follow, of the kind it has first.
    """
    # an array of one, so that what is found first is worked out once
    return F.transform(F.array(_titled_entities(text)), lambda known: F.concat(known, _further_names(text, known)))[0]


def _further_names(text: Column, known: Column) -> Column:
    """Spans of the text's names that stand without a title and in no other entity."""
    names = F.filter(known, lambda s: s["kind"].rlike("^(?:given|family)"))
    forms = F.array_distinct(F.transform(names, lambda s: F.lower(s["value"])))
    words = F.transform(located(text, rf"(?<![\p{{L}}\p{{N}}_]){_NAME_WORD}", ""), _trimmed)
    free = lambda s: ~F.exists(known, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
    again = F.filter(words, lambda s: F.array_contains(forms, F.lower(s["value"])) & free(s))
    typed = F.transform(again, lambda s: F.struct(F.filter(names, lambda n: F.lower(n["value"]) == F.lower(s["value"]))[0]["kind"].alias("kind"),
                                                  s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    return F.when(F.size(names) > 0, typed).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>"))


def _trimmed(span: Column) -> Column:
    """A span of a name without a possessive ending."""
    value = F.regexp_replace(span["value"], NAME_END, "")
    return F.struct(span["kind"].alias("kind"), span["start"].alias("start"), (span["start"] + F.length(value)).alias("end"), value.alias("value"))


def _titled_entities(text: Column) -> Column:
    found = located(text, "|".join(f"(?:{p})" for p in KINDS.values()), "", hint=HINT)
    typed = F.transform(found, lambda s: F.struct(_kind(s["value"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    plain = F.filter(typed, lambda s: s["kind"].isNotNull() & (s["kind"] != "name"))

    def words(s: Column) -> Column:
        title = F.regexp_extract(s["value"], r"^(\S+?)\.? ", 1)
        skip = F.length(F.regexp_extract(s["value"], r"^(\S+ )", 1))
        gender = F.when(title.rlike(f"^(?:{TITLES['m']})$"), "m").when(title.rlike(f"^(?:{TITLES['f']})$"), "f").otherwise("x")
        parts = F.split(F.substr(s["value"], skip + 1), " ")
        return F.transform(parts, lambda w, i: F.struct(
            F.when(i == F.size(parts) - 1, F.lit("family")).otherwise(F.concat(F.lit("given_"), gender)).alias("kind"),
            (s["start"] + skip + F.length(F.array_join(F.slice(parts, 1, i), " ")) + F.when(i > 0, 1).otherwise(0)).alias("start"),
            (s["start"] + skip + F.length(F.array_join(F.slice(parts, 1, i + 1), " "))).alias("end"), w.alias("value")))

    return F.concat(plain, F.flatten(F.transform(F.filter(typed, lambda s: s["kind"] == "name"), lambda s: F.transform(words(s), _trimmed))))


def normal_form(kind: Column, value: Column) -> Column:
    """What mentions of the same entity have in common."""
    return F.when(kind.isin("phone", "card", "account", "ssn"), _digits(value)).when(kind == "iban", F.regexp_replace(value, " ", "")).when(
        kind == "ip", value).otherwise(F.lower(value))


def _draw(key: str, *parts: Column) -> Column:
    """Hex digits of a keyed hash: the key goes in before and after."""
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts], F.lit(key)), 256)


def _number(draw: Column, at: int, of: Column | int) -> Column:
    return F.pmod(F.conv(F.substring(draw, at, 12), 16, 10).cast("long"), F.lit(of) if isinstance(of, int) else of)


def _digit_string(draw: Column) -> Column:
    """60 decimal digits."""
    return F.concat(*[F.lpad(F.conv(F.substring(draw, 1 + 12 * k, 12), 16, 10), 15, "0").substr(4, 12) for k in range(5)])


def _pick(words: str, draw: Column, at: int) -> Column:
    names = words.split()
    return F.get(F.array(*[F.lit(w) for w in names]), _number(draw, at, len(names)).cast("int"))


def _made_name(script: str, draw: Column, end: str) -> Column:
    return F.initcap(F.concat(*[_pick(SYLLABLES[script], draw, 1 + 8 * k) for k in range(5)], F.lit(end)))


def _surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The normal form of a surrogate. Names come from the lists first and are made up from the second try."""
    draw = _draw(key, kind, norm, attempt)
    digits = _digit_string(draw)
    size = F.length(norm)
    local, tail = F.regexp_extract(norm, "^([^@]*)@", 1), F.regexp_extract(norm, r"(\.[a-z]+)$", 1)
    letters = F.translate(F.substring(draw, 1, 24), "0123456789abcdef", "abcdefghjkmnpqrs")
    shown = F.aggregate(F.split(local, ""), F.struct(F.lit(0).alias("i"), F.lit("").alias("out")), lambda acc, c: F.struct(
        (acc["i"] + 1).alias("i"), F.concat(acc["out"], F.when(c.rlike("^[0-9]$"), F.substr(digits, acc["i"] % 48 + 1, F.lit(1))).when(
            c.rlike("^[a-z]$"), F.substr(letters, acc["i"] % 24 + 1, F.lit(1))).otherwise(c)).alias("out")), lambda acc: acc["out"])
    # short local parts have few forms; further tries make them longer
    email = F.concat(shown, F.when(attempt > 0, F.substr(letters, F.lit(13), F.least(attempt, F.lit(12)))).otherwise(""),
                     F.lit("@"), F.translate(F.substring(_draw(key, F.regexp_extract(norm, "@(.*)$", 1)), 1, 8), "0123456789", "ghijklmnop"), tail)
    body = F.concat(F.substring(norm, 1, 1), F.substr(digits, F.lit(1), size - 2))
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    # private addresses first; once these run short, those that are reserved for later use, 15 times as many
    ip = F.concat_ws(".", F.when(attempt == 0, F.lit("10")).otherwise((_number(draw, 37, 15) + 240).cast("string")),
                     *[_number(draw, at, 256).cast("string") for at in (1, 13, 25)])
    phone = F.concat(F.substring(norm, 1, 1), (_number(draw, 49, 8) + 2).cast("string"), F.substr(digits, F.lit(1), size - 2))
    iban = F.concat(F.substring(norm, 1, 2), F.substr(digits, F.lit(1), size - 2))
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", F.concat(body, check.cast("string"))).when(
        kind == "account", F.concat(F.substring(norm, 1, 1), F.substr(digits, F.lit(1), size - 1))).when(
        kind == "phone", phone).when(kind == "ssn", F.concat(F.lit("9"), F.substr(digits, F.lit(1), size - 1))).when(kind == "iban", iban)
    for script in FAMILY:
        own = _script(norm) == script
        out = out.when((kind == "family") & own, F.when(attempt == 0, _pick(FAMILY[script], draw, 41)).otherwise(_made_name(script, draw, "")))
        for gender, end in (("m", {"latin": "n", "cyrillic": "н", "greek": "ς"}), ("f", {"latin": "a", "cyrillic": "а", "greek": "α"})):
            of = (kind == f"given_{gender}") | ((kind == "given_x") & (_number(draw, 33, 2) == (0 if gender == "m" else 1)))
            out = out.when(of & own, F.when(attempt == 0, _pick(GIVEN[f"{script}_{gender}"], draw, 41)).otherwise(_made_name(script, draw, end[script])))
    return F.when(kind.isin("email", "ip", "card", "account", "phone", "ssn", "iban"), out).otherwise(F.lower(out))


def _in_format(kind: Column, surrogate: Column, value: Column) -> Column:
    """The surrogate in the mention's own format: its separators, spaces and capitals."""
    spread = F.aggregate(F.split(value, ""), F.struct(F.lit(1).alias("i"), F.lit("").alias("out")), lambda acc, c: F.when(
        c.rlike("^[0-9A-Za-z]$"), F.struct((acc["i"] + 1).alias("i"), F.concat(acc["out"], F.substr(surrogate, acc["i"], F.lit(1))).alias("out"))).otherwise(
        F.struct(acc["i"].alias("i"), F.concat(acc["out"], c).alias("out"))), lambda acc: acc["out"])
    cased = F.when((F.upper(value) == value) & (F.length(value) > 1), F.upper(surrogate)).otherwise(surrogate)
    named = F.when((F.upper(value) == value) & (F.length(value) > 2), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return F.when(kind.isin("phone", "card", "account", "ssn", "iban"), spread).when(kind == "email", cased).when(kind == "ip", surrogate).otherwise(named)


def surrogates(forms: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for distinct (kind, norm): one to one within a kind, and never a real form.

    All kinds of given names count as one kind here. A form whose surrogate is real or belongs to a form
    before it tries again; each round keeps what is settled in a table.
    """
    family = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind"))
    todo = forms.select("kind", "norm", family.alias("class"))
    real = materialize(todo.select("class", F.col("norm").alias("surrogate")).distinct(), "real_forms")
    todo = todo.withColumn("attempt", F.lit(0))
    settled = None
    for attempt in range(MAX_TRIES):
        tried = todo.withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("norm"), F.lit(attempt)))
        free = tried.join(real, ["class", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("class", "surrogate"), ["class", "surrogate"], "left_anti")
        # few surrogates are listed for many names: a least value is found in the tasks before the shuffle
        won = free.groupBy("class", "surrogate").agg(F.min(F.struct("norm", "kind")).alias("first")).select(
            "first.kind", "first.norm", "class", "surrogate")
        settled = materialize(won if settled is None else settled.unionByName(won), "surrogates")
        todo = materialize(forms.select("kind", "norm", family.alias("class")).join(settled, ["kind", "norm"], "left_anti"), "unsettled")
        if not todo.take(1):
            return settled.select("kind", "norm", "surrogate")
    raise RuntimeError(f"no distinct surrogates after {MAX_TRIES} tries")


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with entities replaced, and ``entities``, the array of (kind, start, end) in the old text.

    A column of that name gives way; ``n_chars`` follows the text. Null texts stay null and have no entities; repeated rows change alike. Rows
    without an entity skip the join with the surrogates, which is by row and not by text.
    """
    rows, text = packed(docs), of("text")
    possible = F.coalesce(text.rlike(HINT), F.lit(False))
    keyed = rows.where(possible).withColumns({"id": of("doc_id"), "key": F.xxhash64(text)})
    spans = materialize(keyed.select("id", "key", entities(text).alias("spans")).where(F.size("spans") > 0), "entities")
    mentions = spans.select("id", "key", F.explode("spans").alias("s")).select(
        "id", "key", "s", F.col("s.kind").alias("kind"), normal_form(F.col("s.kind"), F.col("s.value")).alias("norm"))
    mapped = surrogates(mentions.groupBy("kind", "norm").agg(F.count(F.lit(1)).alias("n")).select("kind", "norm"), key)
    # a form may stand in a third of the rows: equal rows count once here, and the join splits what is left
    done = mentions.distinct().join(mapped, ["kind", "norm"]).select(
        "id", "key", F.struct(F.col("s.start").alias("start"), F.col("s.end").alias("end"), "kind",
                              _in_format(F.col("kind"), F.col("surrogate"), F.col("s.value")).alias("put")).alias("p"))
    done = done.groupBy(F.col("id").alias("of_id"), F.col("key").alias("of_key")).agg(F.array_sort(F.collect_list("p")).alias("puts"))
    some = keyed.join(done, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left")
    new = F.aggregate("puts", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, p: F.struct(
        p["end"].alias("at"), F.concat(acc["out"], F.substr(text, acc["at"] + 1, p["start"] - acc["at"]), p["put"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    places = F.transform("puts", lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    changed = unpacked(some, docs, {"text": F.when(F.col("puts").isNull(), text).otherwise(new), "entities": F.coalesce(places, none)})
    return changed.unionByName(unpacked(rows.where(~possible), docs, {"entities": none}))
