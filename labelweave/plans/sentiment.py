"""Messages to a fitted classifier, predictions and their accuracy."""

from labelweave import fixed
from labelweave.operators import evaluate as ev
from labelweave.operators import textclass as tc
from labelweave.operators.sampling import with_split
from labelweave.sources import sinks


def train_and_score(df, key, predictions_path=None, model_path=None, share=fixed.MESSAGE_TRAIN_SHARE,
                    seed=fixed.MESSAGE_SEED, **settings):
    """Fits on the training rows and scores rows the model has not seen."""
    split = with_split(df, key, share, seed)
    model = tc.fit_classifier(split.filter("split = 'train'"), **settings)
    predictions = tc.classify(model, split.filter("split = 'test'"))
    if predictions_path:
        sinks.write_predictions(predictions, predictions_path)
    if model_path:
        sinks.save_model(model, model_path)
    return model, predictions, ev.accuracy(predictions, "label", "prediction")
