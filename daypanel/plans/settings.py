"""Sizes the registered queries run with; the vocabularies of the stand-ins are small."""

N_DRUGS = 40  # of 100 drug names derived from events
VOCABULARY_SIZES = (60, 40, 20, 10)
LINE_DRUGS = 20  # of 64 part names
BLOCK_ROWS = 500
PAD_STEPS = 10  # shorter than many stays, so that both padding and truncation happen
SCORED_STEPS = 35
LEARN_PASSES = 8  # of the label model; all labels take part
STOP_PASSES = 16  # passes at most for the early stop
LEARN_PATIENCE = 5
SMALL_MODEL = {"embedding": 3, "units": 4, "dense": 5}  # small enough to be written out in SQL
