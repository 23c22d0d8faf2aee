from weirstream.llm.residue import residue_rows

CASES = {
    "The gauge read 3.0 metres, {{constituency}} and no warning was issued.": "template",
    "<%= seat %> Order. I call Ms Fenström.": "template",
    "What the [INSERT topic HERE] plan says": "template",
    "agenda item: [party – TBC]": "template",
    "I thank <<chair>> and %%vote.count%% of you": "template",
    "Je {3} remercie la commission": "template",
    "cars « le <saisir circonscription> jaugeage » et": "template",
    "the (Sitzungsdatum wird nachgetragen) sitting": "template",
    "[party] moved": "template",
    "Sit semper ipsum felis lorem ornare elit amet.": "filler",
    "Costs have risen. Dummy speech for layout check 77.": "filler",
    "Text text text text.": "filler",
    "Beispieltext Beispieltext Beispieltext": "filler",
    "Content goes here.": "filler",
    "We agree on this. The requested file cannot be opened at this time. 403 Forbidden": "error_page",
    "Ceci n’a pas changé. Veuillez vous reconnecter.": "error_page",
    "This site needs JavaScript. Please activate JavaScript.": "scripts",
    "404 Not Found": "error_page",
    "Mr Speaker, the prev… Error 500: the transcript you asked for is not available.": "error_page",
    "Access denied. You do not have permission to view sitting 307.": "error_page",
    'Traceback (most recent call last):\n  File "render.py", line 4, in build\nKeyError: \'speech_body\'': "error_page",
    "Oops! Something went wrong. Reference fd6afcf5.": "error_page",
    "<html><body><h1>Please enable JavaScript to view this transcript.</h1></body></html>": "scripts",
    "Ihr Browser führt keine Skripte aus.": "scripts",
    "word " * 60_000 + "JavaScript is disabled.": "scripts",
}
NONE = [
    None,
    "",
    "  \n ",
    "[Interruption.] The Member [name withheld] said [sic] so. [INAUDIBLE 10:13] [HON. MEMBERS: “Hear, hear!”] (Unruhe im Saal)",
    "<p>Order.</p><br><i>Laughter</i>",
    "The word placeholder appears 15 times in the Bill; that isn't law, that's a sketch.",
    "“Access denied” is what my constituents read when they ask about flood defence.",
    "access denied is what my constituents read when they ask about school meals",
    "a constituent showed me the screen 404 not found nothing else and that is how it treats us",
    "The website was unavailable for 19 days; an internal server error is not a policy.",
    "We were told to enable JavaScript, to clear the cache, to try another browser.",
    "I was asked to turn on scripts in my browser to read a two-page order.",
    "Ohne JavaScript kein Antrag, so sieht die Bürgernähe aus.",
    "Mes administrés lisent « page introuvable » dès qu’ils cherchent la cantine.",
    "The letter began “Dear [Name]”, which tells you how much they care.",
    "The paper went out with lorem ipsum on page 17, and nobody noticed.",
    "Members may wish to insert the words “or its successor” in clause 10.",
    "96% of staff and 5% of £404 a head; he says the session has expired.",
    "clause 9 ordered to stand part of the bill a constituent showed me the screen 404 not found nothing else",
    "She read out “Please log in again to see the record of the " + "very " * 200 + "long debate”, and sat down.",
    "The clerk replied that the page could not be displayed, and nobody laughed.",
    "The manual explains the variable {{constituency}} and the tag <%= seat %> in two lines.",
    "The form said “Dear {{member}}, thank you”, and that was all.",
    "Write `${topic}` where the topic goes.",
    "My neighbour told me the session has expired and an error 404 came up.",
    "Use a field:\n```\nHello {{name}}\n```\nand that is all.",
]


def test_cases(spark):
    texts = [*CASES, *NONE]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, template string")
    got = {r.doc_id: {k for k in ("template", "filler", "error_page", "scripts") if r[k]} for r in residue_rows(df).collect()}
    for i, (t, kind) in enumerate(CASES.items()):
        assert kind in got.get(i, ()), t[:80]
    assert not [texts[i] for i in got if i >= len(CASES)]


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "404 Not Found"), (1, "404 Not Found")], "doc_id bigint, text string")
    assert residue_rows(df).count() == 2 and residue_rows(df.limit(0)).count() == 0


NOISY = {
    "Please log-in again.": "error_page",
    "Your session has timed, um, out.": "error_page",
    "Oops! Something went uh wrong": "error_page",
    "stack-trace": "error_page",
    "We could<br>not find the page you asked, er, for.": "error_page",
    "Bitte melden, Sie sich an.": "error_page",
    "Impossible de<i>charger</i> la page": "error_page",
    "body copy<b>goes</b> here": "filler",
    "test-entry 12, please ignore": "filler",
    "JS is disabled.": "scripts",
}


def test_messages_with_punctuation_tags_and_fillers_between_their_words(spark):
    df = spark.createDataFrame(list(enumerate(NOISY)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in residue_rows(df).collect()}
    assert [t for i, (t, kind) in enumerate(NOISY.items()) if i not in got or not got[i][kind]] == []
