from conftest import SF_SMALL

from kinora.plans.build import CatalogueBuild


def sf_build(spark, sf_dir=SF_SMALL):
    return CatalogueBuild.from_tables(spark, sf_dir)
