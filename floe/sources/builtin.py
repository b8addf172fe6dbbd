"""Built-in default inputs (in-memory rows), used when no input is given.

These are small fixed data sets for demos and golden tests; every registered
query reads the test-data tables instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from floe.schemas import PARAMS, POINTS

# The default word-count text, one entry per line.
DEFAULT_TEXT_LINES = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
    "And by opposing end them?--To die,--to sleep,--",
    "No more; and by a sleep to say we end",
    "The heartache, and the thousand natural shocks",
    "That flesh is heir to,--'tis a consummation",
    "Devoutly to be wish'd. To die,--to sleep;--",
    "To sleep! perchance to dream:--ay, there's the rub;",
    "For in that sleep of death what dreams may come,",
    "When we have shuffled off this mortal coil,",
    "Must give us pause: there's the respect",
    "That makes calamity of so long life;",
    "For who would bear the whips and scorns of time,",
    "The oppressor's wrong, the proud man's contumely,",
    "The pangs of despis'd love, the law's delay,",
    "The insolence of office, and the spurns",
    "That patient merit of the unworthy takes,",
    "When he himself might his quietus make",
    "With a bare bodkin? who would these fardels bear,",
    "To grunt and sweat under a weary life,",
    "But that the dread of something after death,--",
    "The undiscover'd country, from whose bourn",
    "No traveller returns,--puzzles the will,",
    "And makes us rather bear those ills we have",
    "Than fly to others that we know not of?",
    "Thus conscience does make cowards of us all;",
    "And thus the native hue of resolution",
    "Is sicklied o'er with the pale cast of thought;",
    "And enterprises of great pith and moment,",
    "With this regard, their currents turn awry,",
    "And lose the name of action.--Soft you now!",
    "The fair Ophelia!--Nymph, in thy orisons",
    "Be all my sins remember'd.",
]

# The default regression points (x, y) and starting parameters.
DEFAULT_POINTS = [
    (0.5, 1.0), (1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (4.0, 8.0), (5.0, 10.0),
    (6.0, 12.0), (7.0, 14.0), (8.0, 16.0), (9.0, 18.0), (10.0, 20.0),
    (-0.08, -0.16), (0.13, 0.26), (-1.17, -2.35), (1.72, 3.45), (1.70, 3.41),
    (1.20, 2.41), (-0.59, -1.18), (0.28, 0.57), (1.65, 3.30), (-0.55, -1.08),
]
DEFAULT_PARAMS = [(0.0, 0.0)]


def default_text(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(line,) for line in DEFAULT_TEXT_LINES], "value STRING")


def default_points(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_POINTS, POINTS)


def default_params(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_PARAMS, PARAMS)
