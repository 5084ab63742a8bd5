"""Word lists. All values here are fixed: results depend on exactly these."""

from __future__ import annotations

#: English stop words.
STOP_WORDS = tuple(
    """i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
    himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had having do does did doing a an the and but
    if or because as until while of at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
    haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
    weren weren't won won't wouldn wouldn't""".split()
)
#: Further words that no term may hold.
INVALID_WORDS = tuple(
    """other such same similar different relevant specific total appropriate less overall more regardless without due
    thereof please with also would whose yet is 's ( ) [ ] { } be to fields field sections chapter chapters section
    articles article table annex shall whether subparagraph paragraph where referred within may not new old according
    accordance qualify whereas therefore except hereto which whereof since hereby january february march april june
    july august september october november december one two three four five six seven eight nine ten '' `` ` (-) a. b.
    c. d. e. f. g. h. i. j. k. l. m. n. o. p. q. r. s. t. u. v. w. x. y. z. ' | ii iii iv vi vii viii oj ix xi third
    fourth cr equ irb columns column rows row item items point points part parts kind kinds whole best worst""".split()
)
#: Parts of speech that no term may hold.
INVALID_POS = ("ADP", "VERB", "PRON", "CCONJ", "SCONJ", "ADV")
#: Symbols besides ASCII punctuation, digits and the blank, of which alone no term consists.
EXTRA_SYMBOLS = "∙—…·+“√≤<≥>⋅■£½÷«°»–†‡"
#: Common contractions and what they stand for.
CONTRACTIONS = (
    ("can't", "cannot"), ("won't", "will not"), ("shan't", "shall not"), ("n't", " not"), ("'re", " are"), ("'ve", " have"),
    ("'ll", " will"), ("'m", " am"), ("let's", "let us"), ("it's", "it is"), ("that's", "that is"), ("what's", "what is"),
    ("there's", "there is"), ("he's", "he is"), ("she's", "she is"),
)


def invalid_words() -> list[str]:
    """Every word that no term may hold."""
    return sorted({*STOP_WORDS, *INVALID_WORDS})
