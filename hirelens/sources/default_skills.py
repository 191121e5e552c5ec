"""The dictionary used when no other is given."""

from pyspark.sql import DataFrame, SparkSession

from ..operators.skills import dedupe_gazetteer

# Fixed values.
DEFAULT_SKILLS = [
    "Python",
    "Pandas",
    "NumPy",
    "SQL",
    "PostgreSQL",
    "MySQL",
    "dbt",
    "Tableau",
    "Power BI",
    "Airflow",
    "Docker",
    "Kubernetes",
    "Git",
    "GitHub",
    "Linux",
    "Bash",
    "ETL",
    "ELT",
    "Data Engineering",
    "Machine Learning",
    "Deep Learning",
    "NLP",
    "spaCy",
    "scikit-learn",
    "TensorFlow",
    "PyTorch",
    "XGBoost",
    "LightGBM",
    "CatBoost",
    "Hugging Face",
    "Transformers",
    "FAISS",
    "Vector DB",
    "LangChain",
    "R",
    "Excel",
    "Matplotlib",
    "Seaborn",
    "Plotly",
    "Altair",
    "Great Expectations",
    "MLflow",
    "Streamlit",
    "FastAPI",
    "Flask",
    "Ray",
    "Dask",
    "AWS",
    "GCP",
    "Azure",
    "S3",
    "Redshift",
    "BigQuery",
    "Snowflake",
    "Kafka",
    "Spark",
    "Delta Lake",
    "PostGIS",
    "GeoPandas",
]


def default_gazetteer(spark: SparkSession) -> DataFrame:
    return dedupe_gazetteer(spark.createDataFrame(list(enumerate(DEFAULT_SKILLS)), "pos long, skill string"))
