"""decisionkit: supervised-decision analytics as Spark DataFrame operators."""
