"""boostframe: supervised tree boosting on Spark DataFrames."""

from .model import Model
from .operators.fit import (fit, fit_model, fit_xgb_classifier, fit_xgb_regressor, fit_xgb_rf_classifier,
                            fit_xgb_rf_regressor)
from .operators.predict import predict
from .sources.registry import drop_model, list_models, model_info

__all__ = ["Model", "fit", "fit_model", "fit_xgb_classifier", "fit_xgb_regressor", "fit_xgb_rf_classifier",
           "fit_xgb_rf_regressor", "predict", "list_models", "model_info", "drop_model"]
