"""Porter stems as SQL expressions: published and hand-checked examples."""

from quillpair.functions.stem import with_stems

WANT = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "valenci": "valenc", "hesitanci": "hesit",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die", "skies": "sky", "news": "news",
    "is": "is", "": "", "a+": "a+", "Running": "run", "died": "die", "spied": "spi", "enjoying": "enjoy",
}


def test_published_examples(spark):
    df = spark.createDataFrame([(w,) for w in WANT], "w string")
    assert {r.w: r.stem for r in with_stems(df, "w").collect()} == WANT
