from litscout.llm import canonical


def test_long_labels_are_compared_whole():
    label = "pain " * 60
    entity = lambda i, name: {"entity_id": i, "entity_type": "c", "canonical_label": name, "canonical_label_en": None, "slug": None, "aliases_json": None}
    tree = canonical.reference([entity("a", label + "of the knee"), entity("b", label + "of the shoulder")])["c"]
    assert canonical.nearest(tree, (label + "of the KNEE").upper()) == "a" and canonical.nearest(tree, label + "of the sholder") == "b"
    assert canonical.nearest(tree, label) == canonical.UNMATCHED
