"""PII surrogates: keyed replacements of the same type, script, gender and format.

Entities are found by pattern: e-mail addresses, phone and card numbers, IPv4 addresses, account
and social-security numbers, access keys, values of passwords and tokens, and names after an
honorific. Each has an identity that ignores spelling (case, separators, a leading country
code), and its surrogate is a keyed hash of type, identity and attempt, so that all mentions of
one entity agree in every document and on every machine without a table; the surname after an
honorific agrees with or without a given name. The surrogates of numbers keep separators, lengths,
check digits, network and country digits; e-mail addresses are lower-case under example domains and of any length; names
keep script, gender and the letter case of each mention, not their length. Scripts without case have no sign of
where a name ends but white space: of Han, Hangul and kana at most four letters after the honorific are taken.

A given name is one identity whatever its honorifics. Its gender is settled once for the corpus: a
gendered mention beats one without gender, and a name of both genders has none. Only its ending
follows from the gender; names met with several honorific genders are exceptions (below).

After detection each text is searched for further whole-word mentions of its own names (given,
surname or both, any letter case, with or without a honorific); they have the same identities. A word
that is both is a given name before one of the text's surnames, and otherwise a surname. Not found:
names that no honorific precedes anywhere in the same text, nicknames, initials, inflected forms
(but for the Cyrillic feminine surname), names split over lines by a hyphen or joined to digits or underscores.

Collision check: the distinct identities of the corpus are gathered (a row each, combined before
the shuffle), and rounds of joins raise the attempt of every identity whose surrogate another one
has or which is itself an identity of the corpus. Only those exceptions (attempt over 0, a few in
a million, and the given names of mixed mentions) are needed by the second pass: broadcast up to BROADCAST_EXCEPTIONS of them, beyond
that joined to the documents that mention them.

Edge cases: null text stays null, empty text stays empty; texts of any length are read whole;
repeated rows get equal results; null doc_id is kept; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hmac
import re
import secrets
import string
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_arrow, staged

BROADCAST_EXCEPTIONS = 50_000
MAX_ATTEMPTS = 64
#: The Spark setting with the secret of the keyed hash. Where it is unset a session draws its own, so surrogates hold for that session.
KEY_SETTING = "spark.ringfold.pii.key"
#: From these attempts on, surrogates are drawn from all of a format's values, and secrets grow longer.
WIDE, LONGER = 8, 16

# Honorifics by gender.
HONORIFICS = {
    "m": "Mr Mister Sir Herr Monsieur Señor Sr Don Signor Господин Г-н Κύριος",
    "f": "Mrs Ms Miss Madam Frau Madame Mme Mlle Señora Señorita Sra Srta Doña Signora Госпожа Г-жа Κυρία",
    "u": "Dr Prof Doktor Professor",
}
_GENDER = {h.lower(): g for g, hs in HONORIFICS.items() for h in hs.split()}
_NAME = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|\b(?:[Pp]assword|[Pp]asswd|PASSWORD|[Pp]wd|[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Aa]pi[_-]?[Kk]ey|API[_-]?KEY)\b[ \t]*[=:][ \t]*[\"']?(?P<secret>[^\s\"']{6,})"
    r"|(?P<access>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b)"
    rf"|(?P<ip>(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.[0-9]))"
    r"|(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w)"
    r"|(?<![\w.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?!\w)|(?<![\w.-])[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}(?![\w-]))"
    rf"|\b(?P<title>{'|'.join(sorted((re.escape(h) for hs in HONORIFICS.values() for h in hs.split()), key=len, reverse=True))})\b\.?[ ]"
    rf"(?P<name>{_NAME}(?:[ ]{_NAME}){{0,2}})"
)
#: RE2 pattern that every text with an entity matches; texts without it are passed on unread.
TRIGGER = "[0-9@]|AKIA|ASIA|[=:]|" + "|".join(re.escape(h) + r"[. ]" for hs in HONORIFICS.values() for h in hs.split())

# Syllables of invented names by script.
SYLLABLES = {
    "latin": "ba be bo da de di do fa fe ga go ha he ja jo ka ke ko la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se so ta te ti to va ve vi vo",
    "cyrillic": "ба бе бо ва ве ви во га го да де до ка ки ко ла ле ли ло ма ме ми мо на не но па пе ра ре ри ро са се со та те ти то фа фе",
    "greek": "βα βε βο γα γε δα δε δι θα θε κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε ρα ρε ρι ρο σα σε σο τα τε τι το",
}
# Syllables of invented names in scripts without case; other scripts get Latin names.
SYLLABLES |= {
    "han": "安 文 林 江 河 山 石 田 木 本 東 西 南 北 光 明 春 秋 冬 夏 海 川 原 野 谷 村 松 竹 梅 杉",
    "hangul": "가 나 다 라 마 바 사 아 자 하 고 노 도 로 모 보 소 오 조 호 기 니 디 리 미 비 시 이 지 희",
    "kana": "あ い う え お か き く け こ さ し す せ そ た ち つ て と な に ね の は ひ ふ へ ほ ま",
    "arabic": "با تا دا را سا فا كا لا ما نا بو دو رو سو كو لو مو نو بي دي ري سي كي لي مي ني",
    "hebrew": "בא גא דא הא זא טא יא כא לא מא נא סא פא רא שא תא בי גי די לי מי ני רי שי תי",
}
_BLOCKS = (
    (0x370, 0x400, "greek"), (0x400, 0x530, "cyrillic"), (0x590, 0x600, "hebrew"), (0x600, 0x700, "arabic"), (0x3040, 0x3100, "kana"),
    (0x3400, 0xA000, "han"), (0xAC00, 0xD7B0, "hangul"), (0x1F00, 0x2000, "greek"),
)
#: Letters of a name in scripts that write words without spaces between.
UNSPACED, UNSPACED_LETTERS = ("han", "kana", "hangul"), 4
ENDINGS = {
    ("latin", "given", "f"): "na la ra", ("latin", "given", "m"): "n r k", ("latin", "given", "u"): "s l m",
    ("latin", "surname", ""): "ton son man berg let",
    ("cyrillic", "given", "f"): "на ла ра", ("cyrillic", "given", "m"): "н р к", ("cyrillic", "given", "u"): "с л м",
    ("cyrillic", "surname", ""): "нов ров лин тин",
    ("greek", "given", "f"): "να λα ρα", ("greek", "given", "m"): "νος ρος", ("greek", "given", "u"): "ς λ",
    ("greek", "surname", ""): "νιδης ρας λος",
}


def script_of(word: str) -> str:
    c = ord(word[0])
    return next((name for low, high, name in _BLOCKS if low <= c < high), "latin")


class Stream:
    """Keyed pseudo-random numbers for one identity."""

    def __init__(self, key: bytes, kind: str, identity: str, attempt: int) -> None:
        self.seed, self.key, self.n, self.have = f"{kind}\0{identity}\0{attempt}".encode(), key, 0, b""

    def below(self, n: int) -> int:
        if len(self.have) < 4:
            self.have += hmac.digest(self.key, self.seed + self.n.to_bytes(4, "big"), "sha256")
            self.n += 1
        value, self.have = int.from_bytes(self.have[:4], "big"), self.have[4:]
        return value * n >> 32

    def pick(self, options):
        return options[self.below(len(options))]


def entity(kind: str) -> str:
    """The kind without the gender of a given name, by which identities are told apart."""
    return kind[: kind.rindex(":") + 1] if kind.startswith("given:") else kind


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _masked(value: str, rng: Stream) -> str:
    """Each character replaced within its class; hexadecimal text stays hexadecimal."""
    hexed = len(value) >= 8 and all(c in string.hexdigits for c in value)
    out = []
    for c in value:
        if hexed:
            new = rng.pick("0123456789abcdef")
            out.append(new.upper() if c.isupper() else new)
        elif c.isdigit():
            out.append(rng.pick(string.digits))
        elif c.isalpha():
            new = rng.pick(string.ascii_lowercase)
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, identity: str, attempt: int = 0) -> str:
    """The replacement's identity, of the same kind. A given name's gender decides its ending alone."""
    rng = Stream(key, entity(kind), identity, attempt)
    if kind == "email":
        local, _, domain = identity.partition("@")
        host = Stream(key, "domain", domain, 0)
        label = "".join(host.pick(SYLLABLES["latin"].split()) for _ in range(4))
        new = _masked("".join(c if c.isascii() else "x" for c in local), rng)
        if attempt >= 4:  # short names run out of others
            new += "".join(rng.pick(string.ascii_lowercase) for _ in range(attempt // 2))
        return f"{new}@{label}.example.{host.pick(['com', 'net', 'org'])}"
    if kind == "ip" and attempt >= WIDE:
        return ".".join(str(rng.below(256)) for _ in range(4))
    if kind == "ip":
        return ".".join(str(x) for x in (240 + rng.below(15), rng.below(256), rng.below(256), 1 + rng.below(254)))
    if kind == "access":
        return identity[:4] + "".join(rng.pick(string.ascii_uppercase + "234567") for _ in identity[4:])
    if kind == "secret":
        return _masked(identity, rng) + "".join(rng.pick(string.ascii_lowercase) for _ in range(max(0, attempt - LONGER)))
    if kind == "iban":
        body = "".join(rng.pick(string.digits) if c.isdigit() else rng.pick(string.ascii_uppercase) for c in identity[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in body + identity[:2] + "00")) % 97
        return f"{identity[:2]}{check:02d}{body}"
    if kind == "ssn":
        return ("9" if attempt < WIDE else rng.pick(string.digits)) + "".join(rng.pick(string.digits) for _ in identity[1:])
    if kind == "card":
        body = identity[0] + "".join(rng.pick(string.digits) for _ in identity[1:-1])
        valid = [d for d in string.digits if luhn(body + d) == luhn(identity)]
        return body + rng.pick(valid)
    if kind == "phone":
        keep = 2 if identity.startswith("+") else 0
        return identity[:keep] + "".join(rng.pick(string.digits) for _ in identity[keep:])
    part, script, gender = kind.split(":")
    count = 2 + rng.below(2) + attempt // 4
    stem = "".join(rng.pick(SYLLABLES[script].split()) for _ in range(count))
    return stem + rng.pick(ENDINGS.get((script, part, gender), "").split() or [""])


def _identity(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    if kind in ("ssn", "card"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "phone":
        digits = re.sub(r"\D", "", text)
        if len(digits) == 11 and digits[0] == "1":
            return digits[1:]
        return "+" + digits if text.startswith("+") else digits
    return text


_WORD = re.compile(_NAME)
_PIECE = re.compile(r"[^\W\d_]+")


def _spelt(word: str) -> str:
    return word.casefold().replace("’", "'")


def _further(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Mentions of the names found that are not among them."""
    givens: dict[str, tuple[str, str]] = {}
    surnames: dict[str, tuple[str, str]] = {}
    for _, _, kind, who in found:
        names = givens if kind.startswith("given:") else surnames if kind.startswith("surname:") else None
        if names is None or who in _GENDER:
            continue
        old = names.get(_spelt(who))
        if old is not None and old[0] != kind and "given" in kind:
            # a gendered mention beats one without, and both genders make none
            kind = kind if old[0].endswith(":u") else old[0] if kind.endswith(":u") else entity(kind) + "u"
        names[_spelt(who)] = (kind, who)
        if kind == "surname:cyrillic:":
            names.setdefault(_spelt(who) + "а", (kind, who))
    if not givens and not surnames:
        return []
    known = givens.keys() | surnames.keys()
    most = max(len(_PIECE.findall(word)) for word in known)
    more, at = [], 0
    for m in _WORD.finditer(text):
        while at < len(found) and found[at][1] <= m.start():
            at += 1
        pieces = [p.span() for p in _PIECE.finditer(text, *m.span())]
        i = 0
        while i < len(pieces):
            step = 1
            for j in range(min(len(pieces), i + most), i, -1):
                a, b = pieces[i][0], pieces[j - 1][1]
                word = _spelt(text[a:b])
                if word not in known:
                    continue
                step = j - i
                whole = not (a and (text[a - 1].isalnum() or text[a - 1] == "_")) and not (b < len(text) and (text[b].isalnum() or text[b] == "_"))
                k = at
                while k < len(found) and found[k][1] <= a:
                    k += 1
                if whole and (k == len(found) or found[k][0] >= b):
                    more.append((a, b, word))
                break
            i += step
    spans = {e[0] for e in found if e[2].startswith("surname:")} | {a for a, _, word in more if word in surnames}
    out = []
    for a, b, word in more:
        as_given = word in givens and (word not in surnames or (text[b : b + 1] == " " and b + 1 in spans))
        out.append((a, b, *(givens if as_given else surnames)[word]))
    return out


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Entities in order: start, end, kind, identity."""
    found = []
    named = False
    at = 0
    while m := PATTERN.search(text, at):
        kind = m.lastgroup
        if kind != "name":
            start, at = m.span(kind)[0], m.end()
            end = m.end(kind)
            found.append((start, end, kind, _identity(kind, m[kind])))
            continue
        gender = _GENDER[m["title"].lower()]
        words = []
        for w in re.finditer(_NAME, m["name"]):
            if w[0][0].islower():
                break
            words.append(w)
            if not w[0][0].isupper() and script_of(w[0]) in UNSPACED:
                break
        named = named or bool(words)
        at = m.start("name") + words[-1].end() if words else m.start("name")  # an honorific may follow the words that are no name
        for i, w in enumerate(words):
            start = m.start("name") + w.start()
            script = script_of(w[0])
            end = start + (min(len(w[0]), UNSPACED_LETTERS) if script in UNSPACED else len(w[0]))
            if i < len(words) - 1:
                found.append((start, end, f"given:{script}:{gender}", text[start:end].casefold()))
            else:
                stem = text[start:end].casefold()
                if script == "cyrillic" and gender == "f" and stem.endswith("а"):
                    stem = stem[:-1]
                found.append((start, end, f"surname:{script}:", stem))
    return sorted(found + _further(text, found)) if named else found


def render(original: str, kind: str, identity: str, new: str) -> str:
    """The surrogate in the spelling of a mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        chars = iter(new[1:] if new.startswith("+") else new)
        solid = [c.isalnum() for c in original]
        skip = sum(solid) - len(identity.lstrip("+"))  # a country code that the identity leaves out
        out = []
        for c, s in zip(original, solid):
            if s and skip > 0:
                skip -= 1
                out.append(c)
            else:
                out.append(next(chars) if s else c)
        return "".join(out)
    if kind.startswith(("given", "surname")):
        if kind == "surname:cyrillic:" and original.casefold() == identity + "а":
            new += "а"
        if original.islower():
            return new
        return new.upper() if original.isupper() and len(original) > 1 else new.capitalize()
    return new.upper() if kind == "email" and original.isupper() else new


def _found(texts: pa.Array) -> Iterator[tuple[int, str, list[tuple[int, int, str, str]]]]:
    maybe = pc.fill_null(pc.match_substring_regex(texts, TRIGGER), False).to_numpy(zero_copy_only=False)
    for i in maybe.nonzero()[0].tolist():
        text = texts[i].as_py()
        if found := detect(text):
            yield i, text, found


def _identities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = sorted({(kind, who) for _, _, es in _found(batch.column(0)) for _, _, kind, who in es})
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["kind", "identity"])


def _tried(key: bytes, attempt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            new = [surrogate(key, k, n, attempt) for k, n in zip(kinds, names)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "identity", "surrogate"])

    return run


def _entity(kind):
    """`entity` of a column."""
    return F.regexp_replace(kind, "^(given:[^:]*:).*", "$1")


def united(found: DataFrame) -> DataFrame:
    """kind, identity, mixed: one row per identity of the kinds and identities found, given names with their settled gender."""
    kind, is_f, is_m = F.col("kind"), F.col("kind").rlike("^given:.*:f$"), F.col("kind").rlike("^given:.*:m$")
    rows = found.groupBy(_entity(kind).alias("entity"), "identity").agg(
        F.max(is_f).alias("f"), F.max(is_m).alias("m"), F.min("kind").alias("least"), F.max("kind").alias("most")
    )
    both, none = F.col("f") & F.col("m"), ~F.col("f") & ~F.col("m")
    gender = F.when(both | none, "u").when(F.col("f"), "f").otherwise("m")
    named = F.when(F.col("entity").startswith("given:"), F.concat("entity", gender)).otherwise(F.col("entity"))
    return rows.select(named.alias("kind"), "identity", (F.col("least") != F.col("most")).alias("mixed"))


def settle(identities: DataFrame, key: bytes) -> DataFrame:
    """kind, identity, surrogate, attempt of every identity; surrogates of an entity kind are distinct and no identity's.

    Identities are written out; each round those that lose get the next attempt.
    """
    pending, settled = identities, None
    for attempt in range(MAX_ATTEMPTS):
        tried = map_arrow(pending, _tried(key, attempt), "kind string, identity string, surrogate string")
        taken = identities.select(_entity(F.col("kind")).alias("entity"), F.col("identity").alias("surrogate"))
        if settled is not None:
            taken = taken.union(settled.select(_entity(F.col("kind")), "surrogate"))
        tried = staged(tried, "pii-tried")
        free = tried.withColumn("entity", _entity(F.col("kind"))).join(taken, ["entity", "surrogate"], "left_anti")
        first = free.groupBy("entity", "surrogate").agg(F.min(F.struct("identity", "kind")).alias("one"))
        won = first.select("one.kind", "one.identity", "surrogate", F.lit(attempt).alias("attempt"))
        settled = staged(won if settled is None else settled.union(won), "pii-settled")
        pending = staged(tried.join(settled, ["kind", "identity"], "left_anti").select("kind", "identity"), "pii-pending")
        if pending.isEmpty():
            return settled
    raise RuntimeError("no distinct surrogates are left")


def _replacer(key: bytes, exceptions):
    names = ["doc_id", "n_entities", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = exceptions.value if exceptions is not None else {}
        for batch in batches:
            own = batch.column(2).to_pylist() if batch.num_columns > 2 else None
            n, new, at = [0] * batch.num_rows, [], []
            for i, text, found in _found(batch.column(1)):
                odd = shared if own is None else dict(own[i] or [])
                out, end = [], 0
                for a, b, kind, who in found:
                    if change := odd.get(f"{entity(kind)}\0{who}"):
                        kind, attempt = change if own is None else (change["kind"], change["attempt"])
                    else:
                        attempt = 0
                    sub = surrogate(key, kind, who, attempt)
                    out += [text[end:a], render(text[a:b], kind, who, sub)]
                    end = b
                n[i] = len(found)
                at.append(i)
                new.append("".join(out) + text[end:])
            texts = batch.column(1)
            if at:
                mask = [False] * batch.num_rows
                for i in at:
                    mask[i] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(new, texts.type))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), texts], names)

    return run


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = sorted({(batch.column(0)[i].as_py(), entity(kind), who) for i, _, es in _found(batch.column(1)) for _, _, kind, who in es})
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))], ["rid", "entity", "identity"]
        )


def session_key(spark: SparkSession) -> bytes:
    """The key that the session is set to use, or one drawn for its context."""
    context = spark.sparkContext
    if given := spark.conf.get(KEY_SETTING, None):
        return given.encode()
    if not hasattr(context, "_ringfold_pii_key"):
        context._ringfold_pii_key = secrets.token_bytes(32)
    return context._ringfold_pii_key


def replace(docs: DataFrame, key: bytes, broadcast: int = BROADCAST_EXCEPTIONS) -> DataFrame:
    """One row per document: doc_id, n_entities and the text with every entity replaced."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = staged(united(map_arrow(docs.select("text"), _identities, "kind string, identity string")), "pii-identities")
    named = settle(found.select("kind", "identity"), key)
    mixed = found.filter("mixed").select("kind", "identity", "mixed")
    odd = named.join(mixed, ["kind", "identity"], "left").filter("attempt > 0 or mixed")
    odd = staged(odd.select(_entity(F.col("kind")).alias("entity"), "identity", "kind", "attempt"), "pii-exceptions")
    schema = "doc_id long, n_entities long, text string"
    if odd.count() <= broadcast:
        table = {f"{r['entity']}\0{r['identity']}": (r["kind"], r["attempt"]) for r in odd.collect()}
        return map_arrow(docs, _replacer(key, docs.sparkSession.sparkContext.broadcast(table)), schema)
    docs = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    mentions = map_arrow(docs.select("rid", "text"), _mentions, "rid long, entity string, identity string")
    entry = F.struct(F.concat("entity", F.lit("\0"), "identity").alias("key"), F.struct("kind", "attempt").alias("value"))
    own = mentions.join(odd, ["entity", "identity"]).groupBy("rid").agg(F.map_from_entries(F.collect_set(entry)).alias("own"))
    return map_arrow(docs.join(own, "rid", "left").select("doc_id", "text", "own"), _replacer(key, None), schema)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(documents(spark, sf_dir), session_key(spark))
