import random

from changeloom.operators.orphans import ORPHAN_OP, orphan_changes


def test_orphans_follow_every_batch(spark):
    rng = random.Random(5)
    children, parents, orphans = {}, set(), {}
    for _ in range(5):
        changed = {rng.randrange(30) for _ in range(8)}
        for key in changed:
            children.pop(key, None)
            if rng.random() < 0.8:
                children[key] = rng.choice([None, *range(8)])
        before = set(parents)
        for p in rng.sample(range(8), 3):
            parents.symmetric_difference_update({p})
        # one that went and came back within the batch is told as both
        gone, come = before - parents, parents - before
        both = {p for p in before & parents if rng.random() < 0.3}
        frame = lambda rows, names: spark.createDataFrame(rows, names)
        keys = lambda ks: frame([(k,) for k in ks], "id long")
        found = orphan_changes(
            frame(list(orphans.items()), "child long, ref long"), frame(list(children.items()), "child long, ref long"),
            frame([(k,) for k in changed], "child long"), keys(parents), keys(gone | both), keys(come | both),
            child_keys=["child"], reference="ref", parent_key="id",
        )
        rows = found.collect()
        assert len({r.child for r in rows}) == len(rows)
        for r in rows:
            if r[ORPHAN_OP] == "I":
                orphans[r.child] = r.ref
            else:
                orphans.pop(r.child, None)
        assert orphans == {c: p for c, p in children.items() if p is not None and p not in parents}
