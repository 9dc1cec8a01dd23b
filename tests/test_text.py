import pytest
from pyspark.sql import functions as F

from sentilake.functions import text as T


def test_cleaning_chain(column):
    start = "Great!!! game... 10/10 😀"
    steps = [(T.fix_encoding, "Great!!! game... 10/10 "), (T.remove_noise, "Great    game  10 10"),
             (T.lowercase, "great    game  10 10"), (T.remove_numbers, "great    game   ")]
    value = start
    for fn, want in steps:
        value = column(fn, [value])[0]
        assert value == want


def test_unicode_space_and_digits(column):
    assert column(T.remove_noise, ["a b"]) == ["a b"]
    assert column(T.remove_noise, ["  a! "]) == ["a"]
    assert column(T.remove_numbers, ["x٣3"]) == ["x"]


def test_null_passes_through(column):
    for fn in (T.fix_encoding, T.remove_noise, T.lowercase, T.remove_numbers, T.remove_emojis, T.remove_stopwords):
        assert column(fn, [None, "x"])[0] is None


@pytest.mark.parametrize("text,want", [
    ("fun 😀 game", "fun  game"), ("👍🏽 ok", "ok"), ("👨‍👩‍👧 x", "x"), ("5️⃣ stars", "stars"), ("5 stars", "5 stars"),
    ("🇫🇷", ""), ("❤️ it", "it"), ("café ★", "café ★"), ("plain", "plain")])
def test_remove_emojis(column, text, want):
    assert column(T.remove_emojis, [text]) == [want]


def test_remove_stopwords_keeps_negations(column):
    run = lambda v: column(lambda c: T.remove_stopwords(c, {"the", "not", "is"}), [v])[0]
    assert run("The game is not good") == "game not good"
    assert column(T.remove_stopwords, ["The game  isn't very good now"]) == ["game isn't good"]


def test_genres(column):
    assert column(T.extract_genre, ["['Action', 'RPG']", "none", "''", None]) == ["Action", "Unknown", "", "Unknown"]
    assert column(T.smart_category, ["['Action', 'RPG']", "['Racing']", None, "oops", "[]"]) == \
        ["RPG", "Other", "Unknown", "Unknown", "Other"]


def test_normalize_label(column):
    assert column(T.normalize_label, [" Positive.", "not negative, positive", "n/a", None, "Neutral"]) == \
        ["positive", "positive", "neutral", "neutral", "neutral"]


def test_rating_label_and_pos(column):
    assert column(T.rating_label, [1, 0, 2, None], "int") == ["Positive", "Negative", None, None]
    assert column(T.map_pos, ["JJ", "VBD", "NNS", "RB", "DT"]) == ["a", "v", "n", "r", None]


def test_tokenizers(column):
    assert column(lambda c: T.tokenize(c, "opinion"), ["Don't-stop 10 é"]) == [["don't", "stop"]]
    assert column(lambda c: T.tokenize(c, "whitespace"), ["  a b \n c "]) == [["a", "b", "c"]]
    assert column(lambda c: T.tokenize(c, "words2"), ["I am_x é aé 1 12"]) == [["am_x", "aé", "12"]]
    assert column(lambda c: T.tokenize(c, "words1"), ["I am, 1"]) == [["I", "am", "1"]]
    assert column(lambda c: T.tokenize(c, "letters3"), ["The éabc abc1 ab abc"]) == [["the", "abc"]]
    assert column(lambda c: T.tokenize(c, "treebank"), ["I can't, it's ok."]) == \
        [["i", "ca", "n't", ",", "it", "'s", "ok", "."]]
    assert column(lambda c: T.tokenize(c), [None]) == [None]
    with pytest.raises(ValueError):
        T.tokenize(F.lit("x"), "other")


@pytest.mark.parametrize("text,version,want", [
    ("try fingers, but hole", 1, "Contrastive Logic"), ("Gotta love when it crashes", 1, "Sarcasm/Irony"),
    ("best game awful anticheat tho", 1, "Contrastive Logic"), ("button", 1, "Contrastive Logic"),
    ("super earth", 1, "Domain Slang/Memes"), ("a" * 501, 1, "Long-form Noise"), ("fine", 1, "Uncategorized"),
    ("fine", 2, "Too Short / Low Signal"), ("this one gets 10/10 from me, really", 2, "Numeric Rating Language"),
    ("i would give it 5   stars any day", 2, "Numeric Rating Language"),
    ("skill issue for the whole team of them", 2, "Domain Slang/Memes")])
def test_failure_reason(column, text, version, want):
    fn = lambda c: T.failure_reason(c, F.length(c), F.lit("positive"), F.lit("negative"), version)
    assert column(fn, [text]) == [want]


def test_boundary_confusion(column):
    fn = lambda c: T.failure_reason(c, F.length(c), F.lit("Very Positive"), F.lit("positive"), 2)
    assert column(fn, ["thirty characters or more of text"]) == ["Boundary Class Confusion"]


def test_vectors(column):
    assert column(T.parse_vector, ["0.5,-1, 2e1"]) == [[0.5, -1.0, 20.0]]
    assert column(T.clean_vector, [[1.0, float("nan"), float("inf"), float("-inf"), None]], "array<double>") == \
        [[1.0, 0.0, 0.0, 0.0, 0.0]]
