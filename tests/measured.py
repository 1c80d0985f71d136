"""Rows that a plan really shuffled."""


def shuffled_rows(df):
    """Runs the plan; records written by its exchanges (each reused one once)."""
    df.collect()
    seen, todo, total = set(), [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            total += node.metrics().get("shuffleRecordsWritten").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total
