"""kinlink: administrative-records processing on Spark.

Clean multi-year service extracts, fold them into one wide table per
enrollment, link people across agencies, cluster them and derive household
and spell measures.  Every operator is a lazy ``DataFrame -> DataFrame``
function; nothing is collected to the driver.
"""

__version__ = "0.1.0"
