"""vitalframe: Spark-native preparation of irregular ICU observations.

Every public operator is a DataFrame -> DataFrame function built from
Spark SQL expressions, so Catalyst plans, prunes and pushes it down and
Tungsten runs it inside whole-stage code generation.
"""

__version__ = "0.1.0"
