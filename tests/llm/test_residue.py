import pytest

from brezza.llm import queries
from brezza.llm.residue import find_residue, reason_of, residue_coverage, unfilled_slot

HEADING = "COURT OF APPEAL OF PORBRA\nDocket 00-001399/1998\nA.B. v Uxsofen Ltd\n03/12/2004\n\n"
NOTE = "Headnote: The first ground of appeal therefore fails, and the registrar was right to say so.\n\n"
RULING = HEADING + "REASONS\n[1] The sum claimed, € 692656, was reduced at the hearing to reflect the credit given.\n\nORDER\nAppeal dismissed.\nJudge"

RESIDUE = [
    "Please enable JavaScript to view this page.",
    "Loading… If nothing happens, allow scripts for this viewer.",
    "Home · Search · Help\nVeuillez activer JavaScript pour afficher la décision.\nRef. 0376c0",
    "Seite nicht gefunden\nDie angeforderte Entscheidung existiert nicht (mehr). Fehler 404",
    "Traceback (most recent call last):\n  File \"render.py\", line 141, in fetch\nTimeoutError: read timed out",
    "404 Not Found\n\nThe document you asked for could not be delivered. Reference: bfac6a",
    "Accesso negato. La pagina richiesta non è disponibile. Codice 2c84f9",
    "1. TBD\n2. tbc\n3. ...\n4. tbc\n5. to be completed\n6. TBD",
    "Lorem ipsum dolor sit amet, lorem dol cip nec. Vel sus qua tis.",
    "asdf foo asdf blah xxx test qwer text foo blah",
    "Text of ruling to follow. " * 20,
    "Dies ist ein Blindtext ohne Inhalt. " * 3,
]

SLOTS = ["{{ docket_no }}", "${PARTYA}", "#{amount}", "{caseTitle}", "<<COURT>>", "&lt;party_2&gt;", "[[hearing-date]]", "[[:seat:]]", "{% amount %}", "<%= respondent %>", "@@court@@", "%%judge.surname%%",
         "$$amount$$", "__claimant_name__", "«date_decision»", "«amount»", "[INSERT NAME OF PARTY]", "[inserire il nome della parte]", "[Datum eintragen]", "[à compléter]", "(name of judge to be inserted)",
         "<enter docket number>", "[PARTY NAME TBC]", "undefined", "null", "NaN", "[object Object]", "#REF!"]

NO_CASES = [
    None, "", " ", "Leave refused.", "Dismissed.", "§", "Appeal out of time <|endoftext|> refused.", "判決 棄却", "Costs: 1,204.50 + 88.00 = 1,293.25; interest 4½ % p.a. from 3/2/2019.",
    RULING, RULING.replace("A.B.", "[REDACTED]"), RULING.replace("A.B.", "___"), RULING.replace("A.B.", "N***"), RULING.replace("A.B.", "█████"), RULING.replace("A.B.", "(omissis)"), RULING.replace("A.B.", "[name withheld]"),
    RULING.replace("[1]", "[1] La bozza recava ancora «[inserire il nome]» alla clausola 19; l'originale no."),
    RULING.replace("[1]", "[1] Der Entwurf enthielt noch den Vermerk „[Name einsetzen]“, die Urschrift nicht."),
    RULING.replace("[1]", "[1] The draft still read “[insert name of tenant]” in clause 4."),
    RULING.replace("[1]", "[1] The software at issue replaced the marker {{buyer}} with the name held in the ledger."),
    RULING.replace("[1]", "[1] The contract was null and void, and the page said “Access denied”. The site required JavaScript. Page not found was all it showed."),
    RULING.replace("[1]", "[1] Il cartello recava «pagina non trovata»; the note “would follow in due course”, «sarebbe seguita a breve»."),
    RULING.replace("[1]", "[1] In [2009] BRSK 169, [58] this Court held $338472 and 254289 francs payable. None of the parties appeared."),
    "word " * 200_000,
]


@pytest.mark.parametrize("text", RESIDUE)
def test_residue_alone_and_under_a_heading(text):
    assert reason_of(text) == "residue"
    assert reason_of(HEADING + text) == "residue"
    assert reason_of(HEADING + NOTE + text) == "residue"
    assert reason_of((HEADING + NOTE + text).replace("\n", "\r\n").replace(" ", "\xa0")) == "residue"
    assert reason_of((HEADING + NOTE + text).replace("\n", "\n\n\t")) == "residue"


@pytest.mark.parametrize("slot", SLOTS)
def test_slots_in_rulings(slot):
    assert reason_of(RULING.replace("A.B.", slot)) == "slot"
    assert reason_of(RULING.replace("00-001399/1998", slot)) == "slot"
    assert reason_of(RULING.replace("Judge", slot)) == "slot"
    assert reason_of(RULING.replace("credit given.", f"credit given. The sum of {slot} is payable forthwith.")) == "slot"
    assert reason_of(RULING.replace("credit given.", f"credit given. {slot}")) == "slot"


@pytest.mark.parametrize("text", NO_CASES)
def test_no_cases(text):
    assert reason_of(text) is None


def test_coverage_decides():
    sentence = "The ferry concession had been abandoned by the registrar in the spring of that year. "
    assert residue_coverage("Please enable JavaScript to view this page. " + sentence * 3) < 0.5
    assert unfilled_slot("nothing here") is None


def test_tables(spark):
    df = spark.createDataFrame([(1, RESIDUE[0], "x"), (1, RESIDUE[0], "x"), (2, RULING, "x"), (3, None, "x"), (None, RESIDUE[1], "x")], "doc_id bigint, text string, reason string")
    assert sorted((str(r.doc_id), r.reason) for r in find_residue(df, "doc_id", "text").collect()) == [("1", "residue"), ("1", "residue"), ("None", "residue")]
    assert find_residue(df.limit(0), "doc_id", "text").count() == 0


def test_corpus(spark, small):
    found = queries.p9_found(spark, small)
    assert found.dtypes == [("doc_id", "bigint")]
    assert found.count() == found.distinct().count() > 0


def test_time_grows_with_the_length_alone():
    import time

    for piece in ("(", "{{", "__", "[[x ", "«a ", "null,", "lorem ", "<<", "not found ", "{{a", "%%x ", "qwertyqwerty"):
        began = time.perf_counter()
        reason_of(piece * 100_000)
        assert time.perf_counter() - began < 5, piece


def test_slots_of_any_length():
    assert unfilled_slot("The sum of {{ " + "a" * 500 + " }} is due.") is not None
    assert unfilled_slot("The sum of [INSERT " + "THE VERY LONG NAME " * 20 + "] is due.") is not None
    assert unfilled_slot("see {this\nand that}") is None
