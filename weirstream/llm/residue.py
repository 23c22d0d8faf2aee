"""Template residue and error-page text.

Four kinds of remains are looked for, each by its own grammar over the whole text:

* ``template``: a field never filled in, by delimiter-specific grammars (``{{x}}``, ``${x}``, ``<%= x %>``, ``[INSERT x HERE]`` ...).
  Delimiters that prose or markup uses too (``<x>``, ``[x]``, ``{x}``) must hold something that looks like a field name.
* ``filler``: filler in place of a speech, by its stock phrases or by the density of stock Latin.
* ``error_page``: messages of servers, log-ins and stack traces.
* ``scripts``: notices that scripts are needed.

A match alone decides nothing; its surroundings are scored first, and what is only mentioned is cut out before the search:

* code: fenced blocks and inline code;
* quotation: what stands in quotation marks, however long, is reported speech (for fields only where at
  most two words stand on either side of the field, as a field may also have been left in a quoted sentence);
* reporting: the ``REACH`` words after a verb of saying, reading or showing, up to the next end of a clause, and what stands
  as the subject of a judgement ("... is what they read", "... is not a policy");
* tutorial: a field right after a word for template parts ("the variable {{x}}").

Density decides where single words are innocent: stock Latin counts as a run of four, a stock word where it is repeated, and a
message of one or two common words only where it fills its clause.

Defined results: NULL, empty and blank texts are no cases; every text is searched whole; repeated rows are judged alike;
an empty table gives an empty result; other columns are ignored.

Plan: JVM expressions in one narrow stage, no shuffle; scan reads ``doc_id`` and ``text`` only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ID = r"\p{L}[\p{L}\p{N}_.’'-]{0,48}"  # a field name
_IDS = r"\p{L}[\p{L}\p{N}_.’' -]{0,60}?"  # a field name of several words
_ANY = r"[^\[\]\n]{1,60}?"

# Names that stand in a field of a record of debates, in three languages.
FIELDS = (
    "speaker", "seat", "chair", "party", "constituency", "topic", "member", "member name", "sitting date", "session title", "agenda item", "clause no",
    "vote count", "reply text", "opening remarks", "date", "title", "speech", "speech body", "body",
    "rednername", "fraktion", "wahlkreis", "sitzungsdatum", "tagesordnungspunkt", "abstimmungsergebnis",
    "nom de l.orateur", "groupe", "circonscription", "date de séance", "point de l.ordre du jour",
)
# Element names of the markup that may stand around a speech.
MARKUP = "a|abbr|b|big|blockquote|body|br|caption|center|cite|code|dd|div|dl|dt|em|font|footer|h\\d|head|header|hr|html|i|img|li|link|main|meta|nav|ol|p|pre|q|s|script|section|small|span|strong|style|sub|sup|table|tbody|td|th|thead|title|tr|tt|u|ul"

_JOINED = r"(?:\p{L}+(?:[_.-]\p{L}[\p{L}’']*)+|\p{Ll}+(?:\p{Lu}\p{Ll}+)+|\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)+)"
_FIELD = "(?i:" + "|".join(f.replace(" ", "[ _.-]?") for f in FIELDS) + ")"

#: Grammars of fields by the delimiter that opens them.
TEMPLATE = {
    # {x}, {{x}}, ${x}, #{x}, {1}, {!x!}, {% if x %}
    "{": [rf"\{{\s*(?:{_IDS}|\d{{1,2}})\s*\}}", rf"\{{!\s*{_IDS}\s*!?\}}", r"\{%-?\s*\p{L}[^%{}\n]{0,80}%\}"],
    # <%= x %>, <<x>>, <x> where x is no markup, <enter x>, <x eintragen>
    "<": [
        rf"<%=?\s*{_IDS}\s*%>",
        rf"<<\s*{_IDS}\s*>>",
        rf"<(?!(?i:/|(?:{MARKUP})[\s>/])){_ID}>",
        rf"<(?i:enter|saisir|insert|type|add|insérer)\s+{_IDS}>",
        rf"<{_IDS}\s+(?i:eintragen|einfügen|eingeben)>",
    ],
    "%": [rf"%%\s*{_ID}\s*%%", rf"(?<![%\p{{N}}])%{_ID}%(?![%\p{{L}}])"],
    # [[x]], [insert x], [x – TBC], [x], the last only with a name of a field or of several joined parts
    "[": [
        rf"\[\[\s*{_IDS}\s*\]\]",
        rf"\[(?i:insert|add|enter|platzhalter|placeholder|insérer|todo|fill in)\b{_ANY}\]",
        rf"\[YOUR\s{_ANY}\]",
        rf"\[{_ANY}\s?[–:-]\s?(?i:tbc|tbd|à renseigner|à compléter|to follow|folgt)\]",
        rf"\[{_ANY}\s(?i:hier einfügen|hier eintragen|ici|here)\]",
        rf"\[\s*(?:{_JOINED}|{_FIELD})\s*\]",
    ],
    "$(": [rf"\$\(\s*{_IDS}\s*\)"],
    "«": [rf"«{_ID}»"],
    "@@": [rf"@@\s*{_ID}\s*@@"],
    "__": [r"__\p{L}[\p{L}\p{N}.’'-]*(?:_[\p{L}\p{N}.’'-]+)*__"],
    # (x to be supplied)
    "(": [rf"\({_IDS}\s(?i:to be supplied|to be confirmed|to follow|wird nachgetragen|wird ergänzt|à compléter|à préciser|sera précisée?)\)"],
}

# Words of stock filler Latin that no language of the record shares.
LATIN = (
    "lorem ipsum dolor amet consectetur adipiscing elit integer mauris tellus felis nibh nullam ornare porta pretium quisque semper varius vestibulum eiusmod tempor incididunt "
    "labore dolore magna aliqua enim veniam nostrud exercitation ullamco laboris aliquip commodo consequat irure reprehenderit voluptate velit cillum fugiat pariatur excepteur "
    "occaecat cupidatat proident culpa officia deserunt mollit laborum sit"
)
#: Four in a row are dense enough.
def _words(words: list[str]) -> str:
    """One of the words, tried by first letter: most places of a text are settled by one comparison a letter."""
    first: dict[str, list[str]] = {}
    for w in words:
        first.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in first.items()) + ")"


LATIN_RUN = rf"\b(?:{_words(LATIN.split())}[ .,;:!?…]+){{3}}{_words(LATIN.split())}\b"

# The words of the message grammars in three languages, by the part that they play.
THING = "page|site|website|file|document|transcript|record|sitting|segment|debate|content|resource|service|server|seite|datei|dokument|protokoll|dienst|sitzung|ansicht|fichier|compte rendu|séance|contenu|ressource"
REASON = (
    "bad request|unauthori[sz]ed|payment required|forbidden|not found|method not allowed|request time ?out|conflict|gone|too many requests|internal server error|not implemented|"
    "bad gateway|service unavailable|gateway time ?out"
)
FOR_NOW = "temporarily|currently|momentarily|vorübergehend|derzeit|momentan|momentanément|temporairement|actuellement"
SCRIPT = "java ?script|js|scripts?|skripte?"
SWITCH_ON = "enable|activate|allow|turn on|switch on|run"
ASK = "please|veuillez|bitte"
MOCK = "placeholder|dummy|sample|filler|template"
REPORT = (
    "said|says?|told|tells?|asked|asks?|showed|shows?|shown|reads?|wrote|writes?|written|began|begins?|describes?|described|quotes?|quoted|calls?|called|heard|replied|complained?|"
    "sagt|sagte|las|lesen|liest|schrieb|schreibt|stand|steht|stehe|hieß|heißt|zeigte|zeigt|gefragt|aufgefordert|dit|disait|disent|lisent|lit|lire|écrit|affiche|montré|montre|contenait|demandé|faut|commençait"
)
REACH = 8

# the word, then the word again with a blank, a comma or a full stop between
_TWICE = "|".join(f"{w}{between}{w}" for w in ("text", "texte", "copy", "bla", "blah", "qwer", "asdf", "foo", "mustertext", "beispieltext", "blindtext") for between in ("_", ",_", "._"))
#: Grammars of messages by the words without which none of them matches: ``|`` between alternatives, blanks between words that must all occur, ``_`` for a blank itself.
FILLER = {
    "placeholder|dummy|sample|filler|template": rf"\b(?:this is|here is|insert|replace this) (?:an? |the |some )?(?:{MOCK}) (?:copy|text|speech|body|paragraph)\b|\b(?:{MOCK}) (?:copy|text|speech|body) (?:for|body|goes|text|only|please)\b",
    "goes here|replace publishing|test ignore": r"\b(?:copy|text|content|speech) goes here\b|\breplace this \w+ before publishing\b|\btest (?:entry|record|page|document)(?: \w+)? please ignore\b",
    "faux texte|à venir": r"\b(?:ceci est|voici) (?:un |du )?faux texte\b|\bfaux texte pour\b|\btextes? à venir\b",
    "blindtext|mustertext|beispieltext|platzhaltertext|fülltext": r"\b(?:dies|das|hier) ist (?:ein |nur )?(?:blind|muster|beispiel|platzhalter|füll)text\b|\b(?:blind|muster|beispiel|platzhalter|füll)text (?:für|nr)\b",
    _TWICE: r"\b(text|texte|copy|blah?|qwer|asdf|mustertext|beispieltext|blindtext|foo)(?: \1){1,}\b(?: \w+)?(?: \1)?",
    "xxx": r"\bx{3,}(?: x{2,}){2,}\b",
}
ERROR = {
    "not found|forbidden|gateway|server error|unavailable|bad request|unauthori|many requests|request time|not allowed|not implemented|payment|conflict|gone": rf"\b[45]\d\d (?:{REASON})\b",
    "error|fehler|erreur": r"\b(?:error|fehler|erreur)(?: code)? [1-9]\d\d\b|\bfatal error\b|\b\p{L}{2,}error [\p{L}_]",
    "gateway|many requests|unexpected condition|traceback|stack trace|stack-trace|exception": r"\b(?:bad gateway|too many requests|unexpected condition|stack trace|null ?pointer ?exception|traceback most recent call last)\b|\b\p{L}{3,}exception(?: in| at)\b",
    "be displayed|be loaded|be found|be shown|be opened|be reached": rf"\b(?:{THING}) (?:\w+ ){{0,2}}(?:can ?not|can ?t|could not|could ?n t) be (?:displayed|loaded|found|shown|opened|reached)\b|\bcould not be loaded(?: connection| timeout| error| \d|$)",
    "unavailable|not available|erreichbar|verfügbar|indisponible": rf"\b(?:{THING}) (?:is |are |ist |est )?(?:{FOR_NOW}) (?:unavailable|not available|nicht erreichbar|nicht verfügbar|indisponible)\b",
    "could find|could load|could open|could display": rf"\bcould (?:not|n t) (?:find|load|open|display) (?:the |this |that )?(?:{THING}) (?:you|that you|at)\b",
    "you asked for|you requested|you are looking": rf"\b(?:{THING}) you (?:have )?(?:asked for|requested|are looking for) (?:is not available|was not found|does not exist|could not|cannot)\b",
    "nicht geladen|nicht angezeigt|nicht gefunden|nicht geöffnet": rf"\b(?:{THING}) (?:konnte|kann) nicht (?:geladen|angezeigt|gefunden|geöffnet) werden\b|\b(?:{THING}) nicht gefunden\b",
    "introuvable|impossible": r"\b(?:page|fichier|document) introuvable\b|\bimpossible (?:de charger|d afficher|d ouvrir)\b",
    "something wrong": r"\boops ?something went wrong\b|\bsomething went wrong (?:reference|code|please|try)\b",
    "please log|please sign|veuillez|bitte anmelden|bitte melden": rf"\b(?:{ASK}) (?:\w+ ){{0,2}}(?:log ?in|sign ?in|log on|connecter|reconnecter|anmelden)\b|\bbitte melden sie sich an\b",
    "your session|votre session|ihre sitzung": r"\b(?:your|votre|ihre) (?:session|sitzung)(?: a| ist| has)? (?:has )?(?:expired|timed out|expiré|abgelaufen)\b",
    "permission to": r"\b(?:do not|don t) have (?:the )?permission to (?:view|access|see|open)\b",
    "server met|server reset|service reset|connection reset|refused|server timed|service timed|connection timed": r"\b(?:server|service|connection) (?:met an? |reset|refused|timed out)\b",
}
#: Messages of one or two common words: only where they fill their clause.
ALONE = r"(?:^|[.!?…|»”\]] ?)(?:access denied|accès refusé|zugriff verweigert|forbidden|permission denied)(?: ?[.!|]| ?$| you do not)"
ALONE_GATE = "denied|refusé|verweigert|forbidden"
_SWITCHED = "script enabl|script aktiv|script activ|script allow|script turn|script switch|script run|js enabl|js activ|js allow|js turn|cookies|skript"
SCRIPTS = {
    _SWITCHED: rf"\b(?:{ASK}|need to|needs to|must|have to) (?:\w+ ){{0,3}}(?:{SWITCH_ON}) (?:\w+ ){{0,2}}(?:{SCRIPT}|cookies)\b|\benable cookies and (?:{SCRIPT})\b|\baktivieren sie (?:\w+ ){{0,2}}(?:{SCRIPT})\b",
    "script disabled|script off|script blocked|script not enabled|script required|script needed|js disabled|js off|js blocked|js required|js needed": rf"\b(?:{SCRIPT}) (?:is|are) (?:disabled|off|blocked|switched off|turned off|not enabled|required|needed)\b",
    "browser": rf"\bchecking your browser\b|\bturn them on in your browser\b|\bbrowser (?:führt|unterstützt) keine? (?:{SCRIPT})\b",
    "script requires|script needs|js requires|js needs": rf"\b(?:{THING}|player|viewer|app) (?:requires|needs) (?:{SCRIPT})\b",
    "script besoin|script nécessite|script veuillez|script autorise|script active": rf"\b(?:besoin|nécessite)(?: de| des)? (?:{SCRIPT})\b|\b(?:{ASK}) (?:activer|autoriser) (?:\w+ ){{0,2}}(?:{SCRIPT})\b",
}

#: What is reported: the words after a verb of saying up to the end of the clause, and the subject of a judgement.
MENTION = rf"\b(?:{REPORT})\b(?:(?: [\p{{L}}\p{{N}}]+){{0,{REACH - 1}}}? (?:{REPORT})\b)*(?: [\p{{L}}\p{{N}}]+){{1,{REACH}}}|\b(?:[\p{{L}}\p{{N}}]++ ){{1,4}}?(?:is|was|are|were) (?:what|how|not an?|no|the word)\b"
#: Words for the parts of a template: a field right after one is being explained.
EXPLAINED = r"(?i)\b(?:variables?|placeholders?|tags?|tokens?|fields?|syntax|markers?|platzhalter|variablen?|balises?|champs?) (?:called |named |like |such as |namens |wie |nommée? |comme )?"

def _any(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def cleaned(text: Column) -> Column:
    """The text with code cut out, line-end hyphens joined, ligatures resolved and white space as single spaces."""
    where = lambda t, marks, then: F.when(_either([t.contains(m) for m in marks]), then).otherwise(t)
    t = where(text, ("`", "~~~"), F.regexp_replace(text, r"(?s)```.*?```|~~~.*?~~~|`[^`\n]+`", " "))
    t = where(t, ("\n",), F.regexp_replace(t, r"(\p{L})-[ \t]*\r?\n\s*(\p{Ll})", "$1$2"))
    t = F.replace(F.replace(t, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))
    t = F.regexp_replace(t, r"[\s\u00a0\u200b\u202f\ufeff]+", " ")
    return F.trim(t)


def unquoted(t: Column) -> Column:
    """Without quotations: what stands in quotation marks is reported, not said by the publishing system."""
    return F.regexp_replace(t, r"“[^“”]*”|„[^„“”]*[“”]|« [^«»]* »", " quotation ")


def plain(t: Column) -> Column:
    """Lower case with punctuation as single spaces; the ends of clauses are kept, and a capital after a small letter begins one."""
    t = F.regexp_replace(t, r"</?[A-Za-z][A-Za-z0-9]{0,10}>", " | ")
    t = F.regexp_replace(F.lower(F.regexp_replace(t, r"(?<=[\p{Ll}\p{N}]) (?=\p{Lu})", " | ")), r"\b(?:uh|um|er|you know)\b ?", "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}.!?…|»”\[\]]+", " "), r" ?([.!?…|]) ?", " $1 "))


def _either(tests: list[Column]) -> Column:
    """Disjunction as a balanced tree: a long chain would be too deep for the code generator."""
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _either(tests[:half]) | _either(tests[half:])


def _fields(t: Column) -> Column:
    """Whether any delimiter-specific grammar matches; each is tried only where its opening delimiter occurs."""
    return _either([t.contains(opening) & t.rlike(_any(patterns)) for opening, patterns in TEMPLATE.items()])


_FIELD_LIKE = r"(?:[$#]?\{+[^{}]*\}+|\[+[^\[\]]*\]+|<+[^<>]*>+|%+[^%“”]*%+|\$\([^()]*\)|@@[^@“”]*@@|__[^“”]*?__)"


def unmentioned(t: Column) -> Column:
    """Without fields that are quoted by themselves, with at most two words on either side, or explained."""
    quoted = rf"[“„\"](?:[\p{{L}}\p{{N}}]+,? ){{0,2}}{_FIELD_LIKE}(?:,? [\p{{L}}\p{{N}}]+){{0,2}}[.,:!?]?[”“\"]"
    cut = F.regexp_replace(F.regexp_replace(t, quoted, " quotation "), rf"{EXPLAINED}{_FIELD_LIKE}", " mention ")
    return F.when(_either([t.contains(x) for x in ("{", "[", "<", "%", "$(", "@@", "__")]), cut).otherwise(t)


def sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _gate(*gates: str) -> Column:
    ways = list(dict.fromkeys(way for gate in gates for way in gate.split("|")))
    return _either([reduce(and_, [F.col("_low").contains(x.replace("_", " ")) for x in way.split()]) for way in ways])


def _matches(grammars: dict[str, str]) -> Column:
    """Whether one of the grammars matches; each is tried only where its words occur."""
    return _either([_gate(gate) & F.col("_flat").rlike(pattern) for gate, pattern in grammars.items()])


def _filler() -> Column:
    return _matches(FILLER)


def _error() -> Column:
    return _matches(ERROR) | (_gate(ALONE_GATE) & F.col("_say").rlike(ALONE))


def residue(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``template, filler, error_page, scripts`` (booleans, never NULL), and ``_once``, a running id.

    A filter that also looks at ``_once`` stays above this work; without it the optimizer would push the filter down through
    every intermediate form of the text and repeat them.
    """
    once = df.withColumn("_raw", cleaned(F.coalesce(F.col(text), F.lit(""))))
    once = once.withColumn("_tpl", unmentioned(F.col("_raw")))
    # the costlier forms of the text are made only where the words of some message occur, mentions are cut out only where one is met
    once = once.withColumn("_low", F.lower("_raw"))
    gates = {"filler": _gate(*FILLER), "error_page": _gate(*ERROR, ALONE_GATE), "scripts": _gate(*SCRIPTS)}
    once = once.withColumn("_cand", _either(list(gates.values())))
    once = once.withColumn("_say", F.when(F.col("_cand"), F.regexp_replace(plain(unquoted(F.col("_raw"))), r" [.!?…|] (?=[.!?…|])", " ")))
    flat = lambda c: F.regexp_replace(F.regexp_replace(c, r"[.!?…|»”\[\]]", " "), " +", " ")
    once = once.withColumn("_flat", flat(F.col("_say")))
    once = once.withColumn("_met", sure(_either([_filler(), _error(), _matches(SCRIPTS)])))
    once = once.withColumn("_say", F.when(F.col("_met"), F.regexp_replace("_say", MENTION, " mention ")))
    once = once.withColumn("_flat", F.when(F.col("_met"), flat(F.col("_say"))))
    return once.withColumns(
        {
            "template": _fields(F.col("_tpl")),
            "filler": (F.col("_met") & sure(_filler())) | F.col("_low").rlike(LATIN_RUN),
            "error_page": F.col("_met") & sure(_error()),
            "scripts": F.col("_met") & sure(_matches(SCRIPTS)),
            "_once": F.monotonically_increasing_id(),
        }
    ).drop("_raw", "_low", "_tpl", "_say", "_flat", "_cand", "_met")


def residue_rows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, template, filler, error_page, scripts) of the rows that hold remains of the publishing system."""
    return residue(df.select(key, text), text).filter("(template or filler or error_page or scripts) and _once >= 0").drop(text, "_once")
