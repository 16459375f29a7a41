"""Language groups, whitespace, missing-value marks, stop words.

Everything in this module is a constant that results depend on; none of it is logic.
"""

from __future__ import annotations

# Language group -> the spellings (lower case) that belong to it.
LANGUAGE_GROUPS = {
    "English": ("en", "en-us", "english", "eng"),
    "Spanish": ("es", "es-es", "spanish", "español"),
    "French": ("fr", "fr-fr", "french", "français"),
    "Chinese": ("zh", "zh-cn", "chinese", "mandarin"),
    "Italian": ("it", "italian", "italiano"),
    "German": ("de", "german", "deutsch"),
    "Russian": ("ru", "russian"),
    "Portuguese": ("pt", "portuguese", "português"),
}

# The characters ECMAScript's String.trim removes.
BLANKS = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Cell contents that pandas reads as missing in a CSV file.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The English stop words Spark ML ships (StopWordsRemover default), in
# its order. Kept here so that plain SQL can use them without a running JVM.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
    wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought
    that's there's what's when's where's who's why's would
    """.split()
)
