"""What the driver holds while the toxicity model is trained."""

import random
import tracemalloc

from rtdw.llm import toxicity


def test_training_holds_no_strings_of_every_sentence():
    """A set of strings for each sentence took over 100 bytes a word; now all that training holds is a few times the text."""
    rng = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    texts = [". ".join(" ".join(rng.choices(words, k=20)) for _ in range(40)) + (". nasty thing" if i % 3 == 0 else "") for i in range(400)]
    tracemalloc.start()
    model = toxicity.train(texts, [int(i % 3 == 0) for i in range(400)], steps=20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights["nasty"] > 0
    assert peak < 4 * sum(map(len, texts)), peak / sum(map(len, texts))
