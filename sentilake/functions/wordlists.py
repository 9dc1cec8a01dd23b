"""Word lists and lookup values that results depend on.

Everything here is data, not logic. Operators take these as defaults and accept
any other list.
"""

# --- fixed values: opinion lexicon (positive words) ---
POSITIVE_WORDS = frozenset("""
abound abundance abundant accurate achievable admirable admire adorable
adore adroit affable agile alert altruistic amaze amazing amicable ample
amusing appreciate appreciated aspiring astounding authentic balanced
beauteous beautiful beauty beneficial best blessed bliss blissful brave
breathtaking bright brilliant calm capable caring celebrated champion
cheerful clean clever comfortable commendable compassionate competent
confident cool cooperative correct courageous crisp cute decent dedicated
dependable deserve devoted diligent distinct dynamic effective efficient
elegant empathetic encouraging enjoyable enthusiastic exceptional excellent
exciting exhilarating exquisite faithful fantastic fast favorable fine
flexible friendly fun generous genuine good graceful great happy helpful
honorable impressive incredible ingenious innovative inspiring intelligent
invincible joyful kind laudable lively logical lovable lovely loyal
magnificent masterful meritorious mindful natural nice noble outstanding
patient peaceful perfect persevering phenomenal pleasant positive powerful
productive proficient progressive quick reliable remarkable resilient
resourceful satisfying smart solid special spectacular stunning successful
sweet talented thankful thorough trustworthy useful valuable vibrant warm
wonderful worthy addictive engrossing gripping compelling polished smooth
immersive responsive tight flawless crisp rewarding delightful charming
witty clever engaging intuitive accessible deep rich varied enjoyable
superb tremendous terrific stellar flawless masterpiece unique refreshing
underrated gem hidden treasure must-play outstanding smooth fluid dynamic
""".split())

# --- fixed values: opinion lexicon (negative words) ---
NEGATIVE_WORDS = frozenset("""
abrupt absurd awful bad broken buggy cheap clunky confusing corrupt crash
crashes defective delayed disappointing disgusting dull error fail failure
fake faulty frustrating garbage glitch horrible inconsistent inferior irritating
lag lagging messy mediocre nasty never poor problem repetitive ridiculous
rude slow sluggish terrible toxic unreliable useless waste worthless abysmal
annoying atrocious awful bland boring broken buggy chaotic choppy clumsy
crashing dreadful empty excessive exploitative fake fragile frustrating grindy
hollow janky limited mediocre monotonous outdated overpriced painful paywall
pointless punishing shallow sloppy terrible trash underwhelming unfair
unfinished unpolished unresponsive unstable waste broken empty hollow cheating
lying manipulative predatory scam misleading repetitive tedious boring dull
unbalanced unfair unfulfilling unsatisfying lackluster forgettable generic
copy-paste clone bland disappointing letdown broken promises overhyped
""".split())

# --- fixed values: negators of the opinion lexicon ---
OPINION_NEGATORS = frozenset([
    "not", "no", "never", "neither", "nor", "hardly", "barely",
    "scarcely", "doesn't", "don't", "didn't", "isn't", "wasn't",
    "aren't", "weren't", "won't", "wouldn't", "can't", "cannot",
    "couldn't", "shouldn't", "nothing", "nobody", "nowhere",
])

# --- fixed values: intensifiers, multiplier in tenths (15 means x1.5) ---
INTENSIFIERS = {
    "very": 15, "extremely": 20, "absolutely": 20, "totally": 15,
    "completely": 18, "really": 15, "super": 15, "incredibly": 20,
    "truly": 15, "insanely": 20, "ridiculously": 18, "so": 13, "quite": 12,
    "pretty": 12, "highly": 15, "deeply": 15, "genuinely": 13,
    "especially": 13,
}

# --- fixed values: negators of the sense-lexicon scorer (a different set) ---
SENSE_NEGATORS = frozenset([
    "not", "no", "never", "neither", "nor", "nobody",
    "nothing", "nowhere", "hardly", "scarcely", "barely",
    "n't", "nt", "without", "cannot", "can't", "won't",
    "isn't", "aren't", "wasn't", "weren't", "doesn't",
    "don't", "didn't", "hasn't", "haven't", "hadn't",
])

# --- fixed values: opinion words that are never treated as stopwords ---
PROTECTED_WORDS = frozenset([
    "no", "not", "nor", "never", "neither", "nobody", "nothing",
    "nowhere", "hardly", "scarcely", "barely", "don't", "doesn't",
    "didn't", "won't", "wouldn't", "shouldn't", "couldn't", "isn't",
    "aren't", "wasn't", "weren't",
])

# --- fixed values: the common public English stopword list ---
ENGLISH_STOPWORDS = frozenset("""
i me my myself we our ours ourselves you you're you've you'll you'd your
yours yourself yourselves he him his himself she she's her hers herself it
it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having
do does did doing a an the and but if or because as until while of at by for
with about against between into through during before after above below to
from up down in out on off over under again further then once here there when
where why how all any both each few more most other some such no nor not only
own same so than too very s t can will just don don't should should've now d
ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn
hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't
needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won
won't wouldn wouldn't
""".split())

# --- fixed values: words left out of the error-word report ---
ERROR_REPORT_STOPWORDS = frozenset([
    "the", "and", "for", "with", "this", "that", "from", "have", "has",
    "not", "but", "you", "your", "game", "games",
])

# --- fixed values: failure-reason markers, first version ---
FAILURE_MARKERS_V1 = {
    "Sarcasm/Irony": ["gotta love", "i love... sadly"],
    "Contrastive Logic": ["but", "tho", "although"],
    "Domain Slang/Memes": ["try fingers", "super earth", "monster my hunter"],
}

# --- fixed values: failure-reason markers, second version ---
FAILURE_MARKERS_V2 = {
    "Sarcasm/Irony": [
        "gotta love", "i love... sadly", "what a game", "wow amazing",
        "so fun", "totally worth", "best game ever", "couldn't be better",
    ],
    "Contrastive Logic": [
        "but", "tho", "although", "however", "yet", "despite", "even though",
    ],
    "Domain Slang/Memes": [
        "try fingers", "super earth", "monster my hunter",
        "git gud", "skill issue", "cope", "seethe", "gg ez",
        "no cap", "based", "mid game", "goated", "slaps",
    ],
}

# --- fixed values: class pairs counted as boundary confusion ---
BOUNDARY_PAIRS = [
    ("positive", "very positive"),
    ("negative", "very negative"),
    ("very positive", "positive"),
    ("very negative", "negative"),
]

# --- fixed values: category priority ---
CATEGORY_PRIORITY = ["RPG", "Adventure", "Action", "Casual", "Indie"]

# --- fixed values: columns removed from the reduced review table ---
REDUCED_TABLE_DROPS = [
    "recommended", "sentiment_score", "playtime_last_2_weeks",
    "num_games_owned", "is_long_review", "is_hardcore_gamer", "review_month",
    "players_2weeks", "num_reviews_user", "helpful_votes", "funny_votes",
    "rating_label",
]

# --- fixed values: class names in code order 0, 1, 2 ---
CLASSES = ["negative", "neutral", "positive"]

# --- fixed values: noun suffix rules (ending -> replacement) ---
NOUN_SUFFIX_RULES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]

# --- fixed values: degree words of the valence rules, those that raise and those that lower ---
RAISING_WORDS = frozenset("""
absolutely amazingly awfully completely considerable considerably decidedly deeply enormous enormously entirely especially exceptional
exceptionally extreme extremely fabulously flipping frickin frigging fully greatly hella highly hugely incredible incredibly intensely
major majorly more most particularly purely quite really remarkably so substantially thoroughly total totally tremendous tremendously
uber unbelievably unusually utter utterly very
""".split())
LOWERING_WORDS = frozenset("""
almost barely hardly kinda kindof kind-of less little marginal marginally occasional occasionally partly scarce scarcely slight slightly
somewhat sorta sortof sort-of
""".split())

# --- fixed values: negators of the valence rules; words that hold n't count too ---
VALENCE_NEGATORS = frozenset("""
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither neednt never none nope nor not
nothing nowhere oughtnt shant shouldnt wasnt werent without wont wouldnt rarely seldom despite
""".split())
