"""Word lists and tag rules. All are defaults that callers may replace."""

# English stop words (the apostrophe-free part of Spark's default English list).
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being
have has had having do does did doing a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over under again further then once
here there when where why how all any both each few more most other some such no nor not only own same so than too very
s t can will just don should now cannot could ought would
""".split()

# Closed-class words by tag, for the default tagger.
CLOSED_CLASS_TAGS = {
    "DT": "a an the this that these those".split(),
    "IN": "of in for on with by from at as into about than over under".split(),
    "CC": "and or but nor".split(),
    "PRP": "i you he she it we they".split(),
    "TO": "to".split(),
    "MD": "can could may might must shall should will would".split(),
    "VB": "be do go have make see take".split(),
    "VBZ": "is has does".split(),
    "VBD": "was were had did".split(),
    "VBP": "are am".split(),
    "RB": "not very now then here there only".split(),
    "WDT": "which what".split(),
    "CD": "one two three four five six seven eight nine ten".split(),
}

# Suffix rules in order of precedence, for words the lexicon does not hold.
SUFFIX_TAGS = [
    ("tion", "NN"),
    ("ness", "NN"),
    ("ment", "NN"),
    ("ing", "VBG"),
    ("ed", "VBD"),
    ("ly", "RB"),
    ("ble", "JJ"),
    ("ous", "JJ"),
    ("s", "NNS"),
]
