"""Names of one person under several honorifics and further mentions without one."""

from ringfold.llm import pii


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _texts(docs, **kw):
    return [r.text for r in sorted(pii.replace(docs, b"k", **kw).collect(), key=lambda r: r.doc_id)]


def test_a_given_name_is_one_identity(spark):
    docs = _docs(spark, [
        "Frau Anna Meier; Dr Anna Meier", "Dr Anna Meier", "Prof Anna Meier", "Herr Kim Ost", "Frau Kim Ost",
        "Dr Kim Ost", "Dr Jo West",
    ])
    got = _texts(docs)
    names = [set(t.split(" ", 1)[1] for t in x.split("; ")) for x in got]
    assert names[0] == names[1] == names[2] and len(names[0]) == 1
    anna = next(iter(names[0])).split()[0]
    assert anna.endswith(tuple(pii.ENDINGS["latin", "given", "f"].split())) and anna != "Anna"
    assert names[3] == names[4] == names[5] != names[6]  # of both genders: none
    assert next(iter(names[3])).split()[0].endswith(tuple(pii.ENDINGS["latin", "given", "u"].split()))
    assert _texts(docs, broadcast=-1) == got


def test_given_surrogates_differ_between_genders(spark):
    rows = [(f"given:greek:{'mu'[i % 2]}", f"α{i:04d}") for i in range(3000)]
    found = spark.createDataFrame(rows, "kind string, identity string")
    settled = pii.settle(found, b"k").collect()
    assert len(settled) == 3000 and len({r.surrogate for r in settled}) == 3000


def _replaced(text):
    out, end = "", 0
    for a, b, kind, who in pii.detect(text):
        out += text[end:a] + pii.render(text[a:b], kind, who, pii.surrogate(b"k", kind, who))
        end = b
    return out + text[end:]


def test_further_mentions_of_a_name_are_replaced():
    text = (
        "John Smith wrote. Mr. John Smith came. Smith said: JOHN SMITH, smith's, john-smith, 'Smith'. Frau Eva O’Neil; O'Neil's. "
        "Goldsmith smith2 Smithson a_smith. john.smith@x.org"
    )
    new = _replaced(text)
    given, surname = new.split("Mr. ")[1].split()[:2]
    oneil = new.split("Frau ")[1].split()[1].rstrip(";")
    assert new.startswith(
        f"{given} {surname} wrote. Mr. {given} {surname} came. {surname} said: {given.upper()} {surname.upper()}, "
        f"{surname.lower()}'s, {given.lower()}-{surname.lower()}, '{surname}'. Frau "
    )
    assert f"; {oneil}'s. Goldsmith smith2 Smithson a_smith. " in new and new.count(oneil) == 2
    assert "john.smith@" not in new
    assert len(pii.detect(text)) == 2 + 2 + 1 + 2 + 1 + 2 + 1 + 2 + 1 + 1
    russian = _replaced("Госпожа Анна Иванова. Анна пришла, ИВАНОВА ушла. Иванов тут.")
    words = russian.replace(".", "").replace(",", "").split()
    assert words[1] == words[3] and words[2].upper() == words[5] and words[2] == words[7] + "а"
    both = _replaced("Mr. Martin Smith met Mr. Thomas Martin. Martin Smith left, Martin stayed.").replace(".", "").replace(",", "").split()
    assert both[1] == both[7] and both[6] == both[10]
    text = "Herr Professor Weber, ein Professor, Dr Anna Ost: no Name here; none of Ann, Annas or Osten."
    assert len(pii.detect(text)) == 4


def test_further_mentions_over_the_corpus(spark):
    got = _texts(_docs(spark, ["Frau Anna Meier; Anna Meier, MEIER", "Dr Anna Meier", "Anna Meier"]))
    name = got[1][3:]
    assert got[0] == f"Frau {name}; {name}, {name.split()[1].upper()}"
    assert got[2] == "Anna Meier"  # no honorific in the text: not found


def test_names_without_case():
    new = _replaced("Mr. 山田太郎 came, then Mr 김철수 and Dr كريم حسن.")
    assert not any(x in new for x in ("山田", "김철수", "كريم", "حسن")) and new.startswith("Mr. ") and " came, then Mr " in new
    assert pii.script_of(new[4]) == "han" and pii.script_of(new.split("Mr ")[1]) == "hangul"


def test_crowded_formats_are_settled(spark):
    """All six-digit numbers of one prefix are identities: their surrogates leave the format rather than collide."""
    who = spark.createDataFrame([("secret", f"{i:02d}") for i in range(100)], "kind string, identity string")
    rows = pii.settle(who, b"k").collect()
    assert len({r.surrogate for r in rows}) == 100 and not {r.surrogate for r in rows} & {r.identity for r in rows}


def test_the_session_sets_the_key(spark):
    assert pii.session_key(spark) == pii.session_key(spark) and len(pii.session_key(spark)) == 32
    spark.conf.set(pii.KEY_SETTING, "mine")
    assert pii.session_key(spark) == b"mine"
    spark.conf.unset(pii.KEY_SETTING)


def test_every_text_against_plain_code(spark):
    """The whole result: each text with its entities replaced by what `settle` gives their identities."""
    texts = ["Mr. John Smith, a@b.org, 10.1.2.3", "Dr Smith: SSN 123-45-6789, a@b.org", "nothing", "Frau Eva Smith, 10.1.2.3 and 10.1.2.4"]
    docs = _docs(spark, texts)
    got = _texts(docs)
    found = {(pii.entity(k), who): k for x in texts for _, _, k, who in pii.detect(x)}
    named = {(k, who) for (_, who), k in found.items()}
    table = {(r.kind, r.identity): r.surrogate for r in pii.settle(spark.createDataFrame(sorted(named), "kind string, identity string"), b"k").collect()}
    for text, new in zip(texts, got):
        out, end = "", 0
        for a, b, kind, who in pii.detect(text):
            out += text[end:a] + pii.render(text[a:b], kind, who, table[kind, who])
            end = b
        assert new == out + text[end:]
